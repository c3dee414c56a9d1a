"""Format-preserving pseudonyms for numbers and dates that identify people.

Found: payment cards (Luhn check), phone numbers, US social security numbers,
IPv4 addresses and calendar dates from 1900 to 2099, also before a time, with
parts of one digit and with English month names. What looks like one but
fails its check stays. Each is split in two parts and permuted by a keyed
Feistel network within the values its format allows, so the result passes the
same check, equal values get equal pseudonyms in every document, and different
values of a kind different ones. Only SQL functions are used and nothing is
shuffled: every text is rewritten where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY = "1900-01-01"
DAYS = (17, 4297)  # their product is the number of days from 1900 to 2099

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_MONTH, _DAY, _YEAR = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])", r"(?:19|20)\d\d"
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_NAME = rf"(?:{'|'.join(MONTHS)}|sept|{'|'.join(m[:3] for m in MONTHS)})"
_ORDINAL = rf"{_DAY}(?:st|nd|rd|th)?"
NAMED_DATE = rf"(?i:{_NAME}\.? +{_ORDINAL},? +{_YEAR}|{_ORDINAL} +(?:of +)?{_NAME}\.?,? +{_YEAR})"
ISO_DATE = rf"{_YEAR}([-/.]){_MONTH}\{{g}}{_DAY}"
DAY_DATE = rf"{_DAY}([-/.]){_MONTH}\{{g}}{_YEAR}"
MONTH_DATE = rf"{_MONTH}([-/.]){_DAY}\{{g}}{_YEAR}"
IPV4 = rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}(?!\.\d)"
SSN = r"(?!000|666|9)\d{3}(?:-(?!00)\d\d-| (?!00)\d\d )(?!0000)\d{4}"
# With the country code any ten digits are a number, else area and exchange must be valid.
AMERICAN = r"(?:1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-]?)[2-9]\d\d[ .-]?\d{4}|\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}"
FOREIGN = r"\+(?!1)[2-9]\d\d?(?:[ .-]?\(\d{1,4}\))?[ .-]?\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
CARD = r"\d{13,19}|\d{4}([ .-])\d{4}\{g}\d{4}\{g}\d{4}|\d{4}([ .-])\d{6}\{h}\d{5}"
KINDS = ("iso", "day", "month", "named", "ip", "ssn", "american", "foreign", "card")


def _patterns() -> dict[str, str]:
    """Pattern of each kind by itself, with its back references numbered."""
    alone = {
        "iso": ISO_DATE.format(g=1), "day": DAY_DATE.format(g=1), "month": MONTH_DATE.format(g=1), "named": NAMED_DATE, "ip": IPV4, "ssn": SSN,
        "american": AMERICAN, "foreign": FOREIGN,
        "card": CARD.replace("{g}", "1").replace("{h}", "2"),
    }
    return {kind: alone[kind] for kind in KINDS}


def _any_pattern() -> str:
    dates = "|".join(p.format(g=i) for i, p in enumerate((ISO_DATE, DAY_DATE, MONTH_DATE), 1))
    card = CARD.replace("{g}", "4").replace("{h}", "5")
    kinds = rf"(?:{dates}|{NAMED_DATE}|{IPV4}|{SSN}|{AMERICAN}|{FOREIGN}|{card})(?![\w]|[-/]\d)"
    return rf"(?=[\d+(JFMASONDjfmasond])(?<![\w+.]|\d[-/])(?:{kinds}|{ISO_DATE.format(g=6)}(?=[Tt]\d\d))"


def _long(value) -> Column:
    return value.cast("bigint") if isinstance(value, Column) else F.lit(value).cast("bigint")


def feistel(left: Column, lefts, right: Column, rights, key: str, tweak: str) -> Column:
    """The pair (left, right), each below its bound, permuted among all such pairs."""
    def mix(value, turn, bound):
        said = F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), value.cast("string"))
        return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("bigint") % bound

    def step(pair, turn):
        return F.when(turn % 2 == 0, F.struct(
            ((pair["left"] + mix(pair["right"], turn, _long(lefts))) % _long(lefts)).alias("left"), pair["right"].alias("right"))
        ).otherwise(F.struct(
            pair["left"].alias("left"), ((pair["right"] + mix(pair["left"], turn, _long(rights))) % _long(rights)).alias("right")))

    start = F.struct(_long(left).alias("left"), _long(right).alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _padded(value: Column, width) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """A string of digits among all of its length (at most 36)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    bound = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("bigint")
    pair = feistel(F.left(digits, half), bound(half), F.right(digits, rest), bound(rest), key, tweak)
    return _with(pair, lambda p: F.concat(_padded(p["left"], half), _padded(p["right"], rest)))


def _with(value: Column, use) -> Column:
    """Use a value several times, computed once."""
    return F.transform(F.array(value), use)[0]


def luhn_digit(digits: Column) -> Column:
    """The digit that makes the digits pass the Luhn check."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))
    return ((10 - total % 10) % 10).cast("string")


def _refilled(match: Column, digits: Column) -> Column:
    """The match with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(
        F.concat(s["out"], F.substring(digits, s["used"] + 1, F.lit(1))).alias("out"), (s["used"] + 1).alias("used"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["used"].alias("used")))
    return F.aggregate(F.split(match, ""), start, step)["out"]


def _moved_day(year: Column, month: Column, day: Column, key: str, said) -> Column:
    """What is said of the date's pseudonym, null if it is no date."""
    padded = [year, _padded(month, 2), _padded(day, 2)]
    date = F.try_to_timestamp(F.concat_ws("-", *padded), F.lit("yyyy-MM-dd")).cast("date")
    number = F.datediff(date, F.lit(FIRST_DAY).cast("date"))
    pair = feistel(F.floor(number / DAYS[1]), DAYS[0], number % DAYS[1], DAYS[1], key, "date")
    moved = _with(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["left"] * DAYS[1] + p["right"]).cast("int")))
    return F.when(date.isNotNull(), _with(moved, said))


def _moved_date(match: Column, order: str, key: str) -> Column:
    """The pseudonym in the same order and with the same separator, null if it
    is no date. Parts are padded unless one of the match is of one digit."""
    parts, mark = F.split(match, "[-/.]"), F.regexp_extract(match, "[-/.]", 0)
    year, month, day = (F.get(parts, F.lit(i)) for i in {"iso": (0, 1, 2), "day": (2, 1, 0), "month": (2, 0, 1)}[order])
    wide = (F.length(month) == 2) & (F.length(day) == 2)

    def said(d):
        new = {"year": F.date_format(d, "yyyy"),
               "month": F.when(wide | month.startswith("0"), F.date_format(d, "MM")).otherwise(F.date_format(d, "M")),
               "day": F.when(wide | day.startswith("0"), F.date_format(d, "dd")).otherwise(F.date_format(d, "d"))}
        names = {"iso": ("year", "month", "day"), "day": ("day", "month", "year"), "month": ("month", "day", "year")}[order]
        return F.replace(F.concat_ws("-", *[new[n] for n in names]), F.lit("-"), mark)

    return _moved_day(year, month, day, key, said)


def _moved_named_date(match: Column, key: str) -> Column:
    """The pseudonym with its month named in the same length and case."""
    name, day_at = F.regexp_extract(match, f"(?i){_NAME}", 0), r"(?i)(?<!\d)(\d{1,2})(st|nd|rd|th)?(?!\d)"
    day, ordinal = F.regexp_extract(match, day_at, 1), F.regexp_extract(match, day_at, 2)
    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.left(name, F.lit(3))))

    def said(d):
        n = F.dayofmonth(d)
        ending = F.when(n.between(11, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
        new_day = F.concat(F.when(day.startswith("0"), F.date_format(d, "dd")).otherwise(F.date_format(d, "d")),
                           F.when(ordinal == "", "").when(ordinal == F.upper(ordinal), F.upper(ending)).otherwise(ending))
        new_name = F.when(F.lower(name).isin(*MONTHS), F.date_format(d, "MMMM")).otherwise(F.date_format(d, "MMM"))
        new_name = F.when(name == F.upper(name), F.upper(new_name)).when(name == F.lower(name), F.lower(new_name)).otherwise(new_name)
        dated = F.regexp_replace(F.regexp_replace(match, F.lit(day_at), new_day), F.lit(r"\d{4}$"), F.date_format(d, "yyyy"))
        return F.regexp_replace(dated, F.lit(f"(?i){_NAME}"), new_name)

    return _moved_day(F.right(match, F.lit(4)), month, day, key, said)


def _moved_ip(match: Column, key: str) -> Column:
    part = lambda i: F.split_part(match, F.lit("."), F.lit(i)).cast("bigint")
    pair = feistel(part(1) * 256 + part(2), 65536, part(3) * 256 + part(4), 65536, key, "ip")
    return _with(pair, lambda p: F.concat_ws(".", *[
        F.shiftright(p[side], shift).bitwiseAND(255).cast("string") for side in ("left", "right") for shift in (8, 0)]))


def _moved_ssn(match: Column, key: str) -> Column:
    area, group, serial = (F.substring(match, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    # Areas run from 1 to 899 without 666.
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = feistel(place, 898, (group - 1) * 9999 + serial - 1, 99 * 9999, key, "ssn")
    mark = F.substring(match, 4, 1)
    return _with(pair, lambda p: F.concat(
        _padded(p["left"] + 1 + F.when(p["left"] >= 665, 1).otherwise(0), 3), mark,
        _padded(F.floor(p["right"] / 9999) + 1, 2), mark, _padded(p["right"] % 9999 + 1, 4)))


def _moved_american(match: Column, digits: Column, key: str) -> Column:
    """Area and exchange codes do not begin with 0 or 1; numbers where one does
    are permuted among those that break the rule in the same place."""
    ten = F.right(digits, F.lit(10))
    area, rest = F.left(ten, F.lit(3)).cast("bigint"), F.right(ten, F.lit(7)).cast("bigint")
    low_area, low_rest = area < 200, (area >= 200) & (rest < 2000000)
    first = F.when(low_area, 0).otherwise(200)
    first_rest = F.when(low_area | low_rest, 0).otherwise(2000000)
    areas = F.when(low_area, 200).otherwise(800)
    rests = F.when(low_area, 10000000).when(low_rest, 2000000).otherwise(8000000)
    pair = feistel(area - first, areas, rest - first_rest, rests, key, "phone")
    moved = _with(pair, lambda p: F.concat(_padded(p["left"] + first, 3), _padded(p["right"] + first_rest, 7)))
    return _refilled(match, F.concat(F.substring(digits, F.lit(1), F.length(digits) - 10), moved))


def _moved_foreign(match: Column, key: str) -> Column:
    """The first two digits, of the country, stay, and a "(0)" that is not
    dialled from abroad; 7 to 15 digits in all."""
    dialled = F.replace(match, F.lit("(0)"), F.lit("(o)"))
    digits = F.regexp_replace(dialled, "[^0-9]", "")
    fits = F.length(digits).between(7, 15)
    moved = _permuted_digits(F.substring(digits, F.lit(3), F.length(digits)), key, "foreign")
    return F.when(fits, F.replace(_refilled(dialled, F.concat(F.left(digits, F.lit(2)), moved)), F.lit("(o)"), F.lit("(0)")))


def _moved_card(match: Column, digits: Column, key: str) -> Column:
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
    valid = luhn_digit(payload) == F.right(digits, F.lit(1))
    moved = _with(_permuted_digits(payload, key, "card"), lambda p: F.concat(p, luhn_digit(p)))
    return F.when(valid, _refilled(match, moved))


def pseudonym(match: Column, key: str) -> Column:
    """(kind, text): what a match is replaced by, null where it fails its check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    made = {
        "iso": _moved_date(match, "iso", key), "day": _moved_date(match, "day", key), "month": _moved_date(match, "month", key),
        "named": _moved_named_date(match, key),
        "ip": _moved_ip(match, key), "ssn": _moved_ssn(match, key), "american": _moved_american(match, digits, key),
        "foreign": _moved_foreign(match, key), "card": _moved_card(match, digits, key),
    }
    found = None
    for kind, pattern in _patterns().items():
        value = F.struct(F.lit("date" if kind in ("iso", "day", "month", "named") else "number").alias("kind"), made[kind].alias("text"))
        is_kind = match.rlike(f"^(?:{pattern})$")
        found = F.when(is_kind, value) if found is None else found.when(is_kind, value)
    return found


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the rewritten ``text``, ``n_numbers`` and ``n_dates`` replaced.

    Dates are read as year-month-day, else day-month-year, else
    month-day-year (the last two write the same way, so a pseudonym of one may
    equal one of the other). A null text stays null with no replacements, an
    empty one empty. Rows that repeat are rewritten alike; other columns are
    ignored. ``key`` is the secret: whoever has it can undo the permutation.
    """
    text = F.col("text")
    pattern = F.lit(_any_pattern())
    found = F.when(text.rlike(r"\d"), F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    rows = rows.withColumn("found", found)
    rows = rows.withColumn("made", F.transform("found", lambda m: pseudonym(m, key)))
    gaps = F.split(text, _any_pattern(), -1)
    filled = F.zip_with(gaps, F.zip_with("found", "made", lambda m, p: F.coalesce(p["text"], m)),
                        lambda gap, m: F.concat(gap, F.coalesce(m, F.lit(""))))
    count = lambda kind: F.coalesce(F.size(F.filter("made", lambda p: p["text"].isNotNull() & (p["kind"] == kind))), F.lit(0)).cast("bigint")
    return rows.select("doc_id", F.when(F.size("found") > 0, F.array_join(filled, "")).otherwise(text).alias("text"),
                       F.greatest(count("number"), F.lit(0)).alias("n_numbers"), F.greatest(count("date"), F.lit(0)).alias("n_dates"))
