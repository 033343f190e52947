"""Hand-made school rows."""

from pulcra.profiles.schools import RAW_COLUMNS, SCHOOLS

GOOD = {
    "CODIGO": "01-01-0001-46", "DISTRITO": "01-403", "DEPARTAMENTO": "GUATEMALA", "MUNICIPIO": "MIXCO",
    "ZONA_CAPITAL": None, "ESTABLECIMIENTO": "LICEO SAN JOSÉ", "DIRECCION": "3A CALLE 4-55",
    "TELEFONO": "55551234", "SUPERVISOR": "ANA PÉREZ", "DIRECTOR": "JOSÉ LÓPEZ", "NIVEL": "DIVERSIFICADO",
    "SECTOR": "PRIVADO", "AREA": "URBANA", "STATUS": "ABIERTA", "MODALIDAD": "MONOLINGUE",
    "JORNADA": "MATUTINA", "PLAN": "DIARIO(REGULAR)", "DEPARTAMENTAL": "GUATEMALA NORTE",
}
CLEAN_SCHEMA = "row_id bigint, " + ", ".join(f"{c} string" for c in SCHOOLS.clean_columns)
RAW_SCHEMA = "row_id bigint, " + ", ".join(f"{c} string" for c in RAW_COLUMNS)


def clean_table(spark, changes=({},), columns=SCHOOLS.clean_columns):
    rows = [(i, *[{**GOOD, "CODIGO": f"01-01-{i:04d}-46", **change}[c] for c in columns])
            for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"{c} string" for c in columns))


def raw_table(spark, changes):
    return clean_table(spark, changes, RAW_COLUMNS)
