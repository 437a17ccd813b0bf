"""Text expressions: keys, booleans, months, labels, tokens, geometry class."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month names, both spellings of September.
MONTHS = {
    "ENERO": 1, "FEBRERO": 2, "MARZO": 3, "ABRIL": 4, "MAYO": 5, "JUNIO": 6,
    "JULIO": 7, "AGOSTO": 8, "SETIEMBRE": 9, "SEPTIEMBRE": 9, "OCTUBRE": 10,
    "NOVIEMBRE": 11, "DICIEMBRE": 12,
}

# Month labels used as matrix columns.
MONTH_LABELS = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Set", "Oct", "Nov", "Dic")

# Accepted spellings of a boolean.
TRUE_WORDS = ("true", "t", "1", "si", "sí", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")

# Words read as a missing value.
MISSING_WORDS = ("", "NA", "N/A", "NULL", "NAN", "NONE")

# Legal operator name -> company code.
COMPANY_CODES = {
    "COMPAÑIA NACIONAL DE FUERZA Y LUZ S.A.": "CNFL",
    "COOPERATIVA DE ELECTRIFICACION RURAL LOS SANTOS R.L.": "COOPESANTOS",
    "COOPERATIVA DE ELECTRIFICACION RURAL DE SAN CARLOS R.L.": "COOPELESCA",
    "COOPERATIVA DE ELECTRIFICACION RURAL DE GUANACASTE R.L.": "COOPEGUANACASTE",
    "COOPERATIVA DE ELECTRIFICACIÓN RURAL DE ALFARO RUIZ R.L.": "COOPEALFARORUIZ",
    "COOPERATIVA DE ELECTRIFICACION RURAL DE ALFARO RUIZ R.L.": "COOPEALFARORUIZ",
    "EMPRESA DE SERVICIOS PUBLICOS DE HEREDIA S.A.": "ESPH",
    "JUNTA ADMINISTRATIVA DEL SERVICIO ELECTRICO MUNICIPAL DE CARTAGO": "JASEC",
    "INSTITUTO COSTARRICENSE DE ELECTRICIDAD": "ICE",
}

# Tariff -> display label.
TARIFF_LABELS = {
    "RESIDENCIAL": "Residencial (Hogares)",
    "COMERCIOS Y SERVICIOS": "Comercios y Servicios",
    "INDUSTRIAL": "Industrial",
    "PREFERENCIAL": "Preferencial (Educacion/Municipios)",
    "ALUMBRADO PÚBLICO": "Alumbrado Publico",
}

# Operator -> description of its zone.
ZONE_LABELS = {
    "CNFL": "Gran Área Metropolitana",
    "COOPESANTOS": "Zona de Los Santos",
    "COOPELESCA": "Zona Norte",
    "COOPEGUANACASTE": "Provincia de Guanacaste",
    "COOPEGUANACASTE R.L.": "Provincia de Guanacaste",
    "COOPEALFARORUIZ": "Zona de Zarcero y alrededores",
    "COOPEALFARO RUIZ": "Zona de Zarcero y alrededores",
    "ESPH": "Heredia",
    "JASEC": "Cartago",
    "ICE": "Cobertura nacional o zonas amplias del país",
}
NO_ZONE = "Zona no definida"

# Geometry classes, longest prefix first.
GEOMETRY_CLASSES = ("MULTIPOLYGON", "POLYGON", "LINESTRING", "POINT")
NO_GEOMETRY = "DESCONOCIDO"

BLANKS = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.trim(c, F.lit(BLANKS))


def strip_sql(name: str) -> str:
    """The same as SQL text, on the column's text form."""
    return f"trim(BOTH ' \\t\\n\\r\\f\\u000b' FROM CAST({name} AS STRING))"


def clean_key(c: Column) -> Column:
    return F.upper(strip(c))


def blank_to_null(c: Column) -> Column:
    """Null for text that stands for a missing value."""
    return F.when(~clean_key(c).isin(*MISSING_WORDS), c)


def lookup(c: Column, table: Mapping[str, object]) -> Column:
    """Literal map lookup; an unknown or null key gives null."""
    pairs = ", ".join(_literal(part) for pair in table.items() for part in pair)
    return F.try_element_at(F.expr(f"map({pairs})"), c)


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def month_number(c: Column) -> Column:
    return lookup(clean_key(c), MONTHS)


def month_name(month: Column) -> Column:
    """Spanish month name for 1..12, in the spelling with ``p`` for September."""
    names = {number: name.capitalize() for name, number in MONTHS.items()}
    return lookup(month, names)


def company_code(c: Column, codes: Mapping[str, str] = COMPANY_CODES) -> Column:
    return lookup(strip(c), codes)


def tariff_label(c: Column, labels: Mapping[str, str] = TARIFF_LABELS) -> Column:
    return lookup(c, labels)


def zone_label(c: Column, labels: Mapping[str, str] = ZONE_LABELS) -> Column:
    return F.coalesce(lookup(clean_key(c), labels), F.lit(NO_ZONE))


def boolean_text(c: Column) -> Column:
    """True/false for an accepted word, null for anything else."""
    word = F.lower(strip(c.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def boolean_sql(name: str) -> str:
    """The same as SQL text."""
    def words(accepted):
        return ", ".join(f"'{w}'" for w in accepted)

    word = f"lower({strip_sql(name)})"
    return f"CASE WHEN {word} IN ({words(TRUE_WORDS)}) THEN true WHEN {word} IN ({words(FALSE_WORDS)}) THEN false END"


def is_bad_boolean(c: Column) -> Column:
    """True for text that is neither blank nor an accepted word."""
    text = strip(c.cast("string"))
    return F.coalesce((text != "") & boolean_text(c).isNull(), F.lit(False))


def tokens(c: Column) -> Column:
    """Blank-separated tokens; null for empty text."""
    text = strip(c.cast("string"))
    return F.split(F.when(text != "", text), r"\s+")


def token(c: Column, index: int) -> Column:
    """Token at a 0-based index, negative from the end; null outside."""
    return F.try_element_at(tokens(c), F.lit(index + 1 if index >= 0 else index))


def without_token(c: Column, index: int) -> Column:
    """The other tokens joined by one blank; the whole text when the index is outside."""
    words = tokens(c)
    count = F.size(words)
    position = F.lit(index) if index >= 0 else count + index
    rest = F.filter(words, lambda _, i: i != position)
    return F.when(count > 0, F.nullif(F.array_join(rest, " "), F.lit("")))


def natural_key(*parts: Column, prefix: str | None = None) -> Column:
    """Parts joined by a bar; a null part keeps its place as an empty one."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    if prefix is not None:
        texts.insert(0, F.lit(prefix))
    return F.concat_ws("|", *texts)


def geometry_class(c: Column) -> Column:
    """Class from the start of the WKT text, any case."""
    out = F.lit(NO_GEOMETRY)
    for name in reversed(GEOMETRY_CLASSES):
        out = F.when(c.ilike(f"{name}%"), name).otherwise(out)
    return out


def thousands(c: Column, decimals: int = 0) -> Column:
    return F.format_number(c, decimals)


def percent_text(c: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", c)
