"""Forum dates as Column expressions: four notations, tried in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names, accents removed, in lower case.
MONTHS = {
    1: ("jan", "january"), 2: ("fev", "feb", "february"), 3: ("mar", "march"), 4: ("abr", "apr", "april"), 5: ("mai", "maio", "may"), 6: ("jun", "june"),
    7: ("jul", "july"), 8: ("ago", "aug", "august"), 9: ("set", "sep", "sept", "september"), 10: ("out", "oct", "october"), 11: ("nov", "november"), 12: ("dez", "dec", "december"),
}
ACCENTS = ("áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
#: The four notations, as the forums write them.
CLOCK = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?"
NAME = "([A-Za-zÀ-ÿ]+)"
US = rf"(?iU)([0-9]{{1,2}})-([0-9]{{1,2}})-([0-9]{{4}})\s*,?\s*{CLOCK}\s*(am|pm)"
NUMERIC = rf"(?U)([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{2,4}})\s*(?::|,)?\s*{CLOCK}"
MONTH_FIRST = rf"(?iU){NAME}\s+([0-9]{{1,2}}),\s*([0-9]{{4}})\s+{CLOCK}\s*(am|pm)?"
DAY_FIRST = rf"(?iU)([0-9]{{1,2}})\s+{NAME}\s+([0-9]{{4}})\s*,?\s*{CLOCK}\s*(am|pm)?"


def month_number(name: Column) -> Column:
    plain = F.translate(F.lower(name), *ACCENTS)
    out = F.lit(None).cast("int")
    for n, names in MONTHS.items():
        out = F.when(plain.isin(*names), F.lit(n)).otherwise(out)
    return out


def parse_forum_date(raw: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS``, or null.

    A notation that matches decides alone: an impossible date there is null, not a try at the
    next.  Two-digit years from 70 are of the 1900s.
    """

    def parts(pattern: str, year: int, month: int, day: int, half: bool) -> Column:
        g = lambda i: F.regexp_extract(raw, pattern, i)
        return F.struct(g(year).alias("year"), g(month).alias("month"), g(day).alias("day"), g(4).alias("hour"), g(5).alias("minute"), g(6).alias("second"), (F.lower(g(7)) if half else F.lit("")).alias("half"))

    found = F.when(raw.rlike(US), parts(US, 3, 1, 2, True)).when(raw.rlike(NUMERIC), parts(NUMERIC, 3, 2, 1, False)).when(raw.rlike(MONTH_FIRST), parts(MONTH_FIRST, 3, 1, 2, True)).when(raw.rlike(DAY_FIRST), parts(DAY_FIRST, 3, 2, 1, True))

    def build(p: Column) -> Column:
        n = lambda c: p[c].try_cast("int")
        year = n("year") + F.when(F.length(p["year"]) > 2, 0).when(n("year") < 70, 2000).otherwise(1900)
        month = F.coalesce(n("month"), month_number(p["month"]))
        hour = n("hour") + F.when((p["half"] == "pm") & (n("hour") < 12), 12).when((p["half"] == "am") & (n("hour") == 12), -12).otherwise(0)
        text = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", year, month, n("day"), hour, n("minute"), F.coalesce(n("second"), F.lit(0)))
        return F.when(month.isNotNull() & F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull(), text)

    # one evaluation of the fields, however often they are used
    return F.get(F.transform(F.array(found), build), F.lit(0))
