"""City and department names typed by hand, brought to one spelling.

Rules are ordered data: each replaces every match, and later rules see the result of earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import letter_words, strip_accents

# The city rules, in the order in which they apply.
CITY_RULES = [
    (r"Aguazul\s?\w+", "Aguazul"),
    (r"Agustin\s?Co\w+", "Agustín Codazzi"),
    (r"Alta\sM\w+", "Altamira"),
    (r"Aranzazu\s?\w+", "Aranzazu"),
    (r"Armenia\s?\w+", "Armenia"),
    (r"Armero\s?\w+", "Armero"),
    (r"Barranca\s?\w+", "Barrancabermeja"),
    (r"Bar(r)?[iar]\w+la.*", "Barranquilla"),
    (r"(\w+\s)?Bello(\s\w+)?", "Bello"),
    (r"Bela[ln]ca[zs]ar(\w+)?", "Belalcazar"),
    (r"Bo[gb]?[oa]\w+.*", "Bogotá"),
    (r"(Teusaquillo|Suba|Kennedy|Ciudad Bolivar)", "Bogotá"),
    (r"Bu[ca][car]\w+(ga|ag).*", "Bucaramanga"),
    (r"Buena\s?[Vv]\w+ra", "Buenaventura"),
    (r"Carmen Del? [VB]\w+ral?", "Carmen de Viboral"),
    (r"Ca[rs]?t[ae]gena.*", "Cartagena"),
    (r"Cajii?ca.*", "Cajicá"),
    (r".*\bCali\b.*", "Cali"),
    (r".*\bCucu\w?ta\b.*", "Cúcuta"),
    (r".*Mani[zs]ale[zs].*", "Manizales"),
    (r".*\bMedel.*", "Medellín"),
    (r"Ibagu?e", "Ibagué"),
    (r".*Pereira", "Pereira"),
    (r"San\s?a?([Tt]a)?\s?[Mm]\w+ta", "Santa Marta"),
    (r".*Pasto\b.*", "Pasto"),
    (r".*Monter[ i][Aa]\b.*", "Montería"),
    (r".*Tunja\b.*", "Tunja"),
    (r".*Rioh?acha\b.*", "Riohacha"),
    (r"Sangil", "San Gil"),
    (r".*Palmira\b.*", "Palmira"),
    (r".*Faca[ct]\w+a\b.*", "Facatativá"),
    (r".*Madri[dr]", "Madrid"),
    (r".*Chia\b.*", "Chía"),
    (r".*Cajica\b.*", "Cajicá"),
    (r".*Pie\s?[dD]e\s?[cCs].*", "Piedecuesta"),
    (r"\w*\s*Neiva", "Neiva"),
    (r"San Andres\b.*", "San Andrés"),
    (r".*Fusa\w*\b.*", "Fusagasugá"),
    (r"Villa\w+cio[\s\w]*", "Villavicencio"),
    (r".*Yumbo", "Yumbo"),
    (r"Zipa[rq]\w+", "Zipaquira"),
]

# The department rules, in the order in which they apply.
DEPARTMENT_RULES = [
    (r".*Atlantico\b.*", "Atlántico"),
    (r".*Bolivar\b.*", "Bolívar"),
    (r".*Boyaca\b.*", "Boyacá"),
    (r".*Caqueta\b.*", "Caquetá"),
    (r".*Choco\b.*", "Chocó"),
    (r".*Cordoba\b.*", "Córdoba"),
    (r".*Guainia\b.*", "Guainía"),
    (r".*Narino\b.*", "Nariño"),
    (r".*Quindio\b.*", "Quindío"),
    (r".*San Andres Y Providencia\b.*", "San Andrés Y Providencia"),
    (r".*Vaupes\b.*", "Vaupés"),
]


def canonical(col: Column, rules: list[tuple[str, str]]) -> Column:
    """Letters only, title case, no accents, then the rules."""
    out = strip_accents(letter_words(col))
    for pattern, name in rules:
        out = F.regexp_replace(out, "(?U)" + pattern, name)
    return out


def canonical_places(df: DataFrame, rules_by_column: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """Replace place columns by their canonical names; expressions of the row, without a shuffle. Null becomes ''."""
    return df.withColumns({column: canonical(F.col(column), rules) for column, rules in rules_by_column.items()})
