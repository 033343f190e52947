"""Profile of a registry of upper-secondary schools.

The 340 (department, municipality) pairs are not embedded: pass the official
catalogue as a two-column DataFrame wherever an operator asks for it.
"""

from __future__ import annotations

from pulcra.functions.chars import DIGIT
from pulcra.profile import CHECKS, Profile, Zone

# Columns of the raw table, in order.
RAW_COLUMNS = (
    "CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO",
    "DIRECCION", "TELEFONO", "SUPERVISOR", "DIRECTOR", "NIVEL", "SECTOR",
    "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN", "DEPARTAMENTAL",
)

# Identifier shapes NN-NN-NNNN-NN, NN-NNN and NN-NN-NNNN.
CODE_SHAPE = rf"{DIGIT}{{2}}-{DIGIT}{{2}}-{DIGIT}{{4}}-{DIGIT}{{2}}"
DISTRICT_SHAPES = (rf"{DIGIT}{{2}}-{DIGIT}{{3}}", rf"{DIGIT}{{2}}-{DIGIT}{{2}}-{DIGIT}{{4}}")

# The official departments.
DEPARTMENTS = (
    "ALTA VERAPAZ", "BAJA VERAPAZ", "CHIMALTENANGO", "CHIQUIMULA", "EL PROGRESO",
    "ESCUINTLA", "GUATEMALA", "HUEHUETENANGO", "IZABAL", "JALAPA", "JUTIAPA",
    "PETEN", "QUETZALTENANGO", "QUICHE", "RETALHULEU", "SACATEPEQUEZ",
    "SAN MARCOS", "SANTA ROSA", "SOLOLA", "SUCHITEPEQUEZ", "TOTONICAPAN", "ZACAPA",
)

# Regional offices that are not named like a department.
SPLIT_OFFICES = (
    "GUATEMALA NORTE", "GUATEMALA OCCIDENTE", "GUATEMALA ORIENTE", "GUATEMALA SUR",
    "QUICHE NORTE",
)

# Legal categories.
DOMAINS = {
    "DEPARTAMENTO": DEPARTMENTS,
    "NIVEL": ("DIVERSIFICADO",),
    "SECTOR": ("OFICIAL", "PRIVADO", "COOPERATIVA", "MUNICIPAL"),
    "AREA": ("URBANA", "RURAL", "SIN ESPECIFICAR"),
    "STATUS": (
        "ABIERTA", "CERRADA TEMPORALMENTE", "CERRADA DEFINITIVAMENTE",
        "TEMPORAL TITULOS", "TEMPORAL NOMBRAMIENTO",
    ),
    "MODALIDAD": ("MONOLINGUE", "BILINGUE"),
    "JORNADA": ("MATUTINA", "VESPERTINA", "NOCTURNA", "DOBLE", "INTERMEDIA", "SIN JORNADA"),
    "PLAN": (
        "A DISTANCIA", "DIARIO(REGULAR)", "DOMINICAL", "FIN DE SEMANA", "INTERCALADO",
        "IRREGULAR", "MIXTO", "SABATINO", "SEMIPRESENCIAL",
        "SEMIPRESENCIAL (DOS DIAS A LA SEMANA)", "SEMIPRESENCIAL (FIN DE SEMANA)",
        "SEMIPRESENCIAL (UN DIA A LA SEMANA)", "VIRTUAL A DISTANCIA",
    ),
    "DEPARTAMENTAL": tuple(d for d in DEPARTMENTS if d != "GUATEMALA") + SPLIT_OFFICES,
}

# Municipality names and their official equivalents.
MUNICIPALITY_MAP = {
    "LA TINTA": "SANTA CATALINA LA TINTA",
    "SAN MIGUEL TUCURU": "TUCURU",
    "SANTA CRUZ EL CHOL": "EL CHOL",
    "SAN PEDRO YEPOCAPA": "YEPOCAPA",
    "SAN MIGUEL POCHUTA": "POCHUTA",
    "COLOMBA COSTA CUCA": "COLOMBA",
    "GENOVA COSTA CUCA": "GENOVA",
    "SAN MIGUEL USPANTAN": "USPANTAN",
    "SANTO TOMAS CHICHICASTENANGO": "CHICHICASTENANGO",
    "PACHALUN": "PACHALUM",
    "SAN MIGUEL DUENAS": "SAN MIGUEL DUENAS",
    "SAN JOSE EL RODEO": "EL RODEO",
    "PUEBLO NUEVO": "PUEBLO NUEVO SUCHITEPEQUEZ",
    "SAN MIGUEL PANAM": "SAN MIGUEL PANAN",
    "SAN BARTOLO AGUAS CALIENTES": "SAN BARTOLO",
}

# Query codes of the source, by department and by level.
DEPARTMENT_CODES = {
    "ALTA VERAPAZ": "16", "BAJA VERAPAZ": "15", "CHIMALTENANGO": "04",
    "CHIQUIMULA": "20", "CIUDAD CAPITAL": "00", "EL PROGRESO": "02",
    "ESCUINTLA": "05", "GUATEMALA": "01", "HUEHUETENANGO": "13", "IZABAL": "18",
    "JALAPA": "21", "JUTIAPA": "22", "PETEN": "17", "QUETZALTENANGO": "09",
    "QUICHE": "14", "RETALHULEU": "11", "SACATEPEQUEZ": "03", "SAN MARCOS": "12",
    "SANTA ROSA": "06", "SOLOLA": "07", "SUCHITEPEQUEZ": "10",
    "TOTONICAPAN": "08", "ZACAPA": "19",
}
LEVEL_CODES = {
    "BASICO": "45", "DIVERSIFICADO": "46", "PARVULOS": "42",
    "PREPRIMARIA BILINGUE": "41", "PRIMARIA": "43", "PRIMARIA DE ADULTOS": "44",
}

# Names under which the seven checks are reported.
CHECK_NAMES = dict(zip(CHECKS, (
    "Duplicados exactos", "Espacios en textos", "Formato de teléfonos",
    "Geografía oficial", "Esquema y tipos", "Categorías equivalentes",
    "Valores inválidos diagnosticados",
)))

# The registry's columns by role, below too.
_CATEGORIES = (
    "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN", "DEPARTAMENTAL",
)
_UNIT = ("DEPARTAMENTO", "MUNICIPIO", *_CATEGORIES)

SCHOOLS = Profile(
    name="schools",
    columns=RAW_COLUMNS,
    code="CODIGO",
    code_patterns=(CODE_SHAPE,),
    parent="DEPARTAMENTO",
    child="MUNICIPIO",
    title="ESTABLECIMIENTO",
    address="DIRECCION",
    phone="TELEFONO",
    identifiers={"DISTRITO": DISTRICT_SHAPES},
    free_text=("ESTABLECIMIENTO", "DIRECCION", "SUPERVISOR", "DIRECTOR"),
    dashed="DIRECTOR",
    categories=_CATEGORIES,
    reported_categories=("PLAN", "DEPARTAMENTAL"),
    variant_columns=("DEPARTAMENTO", "MUNICIPIO", "ZONA_CAPITAL", *_CATEGORIES),
    domains=DOMAINS,
    required=("CODIGO", *_UNIT),
    label="DEPARTAMENTAL",
    zone=Zone(
        column="ZONA_CAPITAL", capital="CIUDAD CAPITAL",
        derive_pattern=rf"ZONA {DIGIT}{{1,2}}", valid_pattern=rf"ZONA (?:[1-9]|1{DIGIT}|2[0-5])",
        parent="GUATEMALA", child="GUATEMALA",
    ),
    parent_map={"CIUDAD CAPITAL": "GUATEMALA"},
    child_map=MUNICIPALITY_MAP,
    unit=_UNIT,
    compared=("DISTRITO", "ESTABLECIMIENTO", "DIRECCION", "TELEFONO", "SUPERVISOR",
              "DIRECTOR", *_UNIT),
    check_names=CHECK_NAMES,
)
