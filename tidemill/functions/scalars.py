"""Column functions: guarded division, instrument codes, dates and contract codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b as a double; null where b is zero."""
    d = col(b).cast("double")
    return col(a).cast("double") / F.when(d != 0, d)


def number(c: ColumnOrName) -> Column:
    """NaN and infinities as null: nulls are what aggregates skip."""
    d = col(c)
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def lookup(table: dict, key: Column, default: Column | None = None) -> Column:
    """The value of ``key`` in a small fixed table (a literal map)."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, default)


# --- instrument codes -------------------------------------------------------------------


def unify_code(code: ColumnOrName, default: str = "SH") -> Column:
    """Six digits to digits.EXCHANGE by the first digit; codes with a dot stay."""
    c = col(code)
    return (
        F.when(c.contains("."), c)
        .when(c.startswith("6"), F.concat(c, F.lit(".SH")))
        .when(c.startswith("0") | c.startswith("3"), F.concat(c, F.lit(".SZ")))
        .when(c.startswith("8") | c.startswith("4"), F.concat(c, F.lit(".BJ")))
        .otherwise(F.concat(c, F.lit("." + default.upper())))
    )


def from_prefixed(code: ColumnOrName) -> Column:
    """``sh.600000`` to ``600000.SH``; codes whose first part isn't letters stay."""
    c = col(code)
    return F.when(c.rlike(r"^[A-Za-z]+\.[^.]+$"), F.concat(F.substring_index(c, ".", -1), F.lit("."), F.upper(F.substring_index(c, ".", 1)))).otherwise(c)


def to_prefixed(code: ColumnOrName) -> Column:
    """``600000.SH`` to ``sh.600000``; prefixed codes stay."""
    c = col(code)
    return F.when(c.rlike(r"^[^.]+\.[A-Za-z]+$"), F.concat(F.lower(F.substring_index(c, ".", -1)), F.lit("."), F.substring_index(c, ".", 1))).otherwise(c)


# The exchange suffixes of one vendor, and the common ones.
VENDOR_SUFFIXES = {"XSHE": "SZ", "XSHG": "SH", "XBJ": "BJ"}


def _swap_suffix(code: ColumnOrName, table: dict) -> Column:
    c = col(code)
    suffix = F.substring_index(c, ".", -1)
    return F.when(c.contains("."), F.concat(F.substring_index(c, ".", 1), F.lit("."), lookup(table, suffix, suffix))).otherwise(c)


def from_vendor_suffix(code: ColumnOrName, market: str = "SZ") -> Column:
    return unify_code(_swap_suffix(code, VENDOR_SUFFIXES), market)


def to_vendor_suffix(code: ColumnOrName) -> Column:
    return _swap_suffix(code, {v: k for k, v in VENDOR_SUFFIXES.items()})


def bond_code(code: ColumnOrName) -> Column:
    c = col(code)
    return F.when(c.contains("."), c).when(c.startswith("11"), F.concat(c, F.lit(".SH"))).otherwise(F.concat(c, F.lit(".SZ")))


def strip_suffix(code: ColumnOrName) -> Column:
    return F.substring_index(col(code), ".", 1)


# --- contracts --------------------------------------------------------------------------

# The exchange of each futures underlying.
FUTURES_EXCHANGES = {
    "CFFEX": ("IF", "IH", "IC", "IM", "T", "TF", "TS"),
    "SHFE": ("CU", "AL", "ZN", "PB", "NI", "SN", "AU", "AG", "RB", "WR", "HC", "SS", "BU", "RU", "FU", "SP"),
    "DCE": ("A", "B", "M", "Y", "P", "C", "CS", "JD", "L", "V", "PP", "EB", "EG", "J", "JM", "I"),
    "CZCE": ("SR", "CF", "ZC", "TA", "MA", "FG", "RM", "OI", "AP", "CJ", "UR", "SA"),
}
# The suffix of each underlying in the other vendor's codes.
FUTURES_SUFFIXES = {
    "CFE": ("if", "ic", "ih", "im", "tf", "t", "ts"),
    "SHF": ("cu", "al", "zn", "pb", "ni", "sn", "au", "ag", "rb", "hc", "ss", "bu", "ru", "fu", "sp"),
    "DCE": ("m", "y", "p", "c", "cs", "a", "b", "jd", "l", "v", "pp", "j", "jm", "i", "eg", "eb", "pg", "lh"),
    "CZC": ("sr", "cf", "ta", "ma", "oi", "rm", "fg", "sa", "ur", "ap", "cj", "pf", "pk", "sh", "si"),
    "INE": ("sc", "lu", "nr", "bc"),
}


def _inverted(table: dict) -> dict:
    return {x: k for k, xs in table.items() for x in xs}


def futures_exchange(underlying: ColumnOrName) -> Column:
    return lookup(_inverted(FUTURES_EXCHANGES), col(underlying), F.lit("UNKNOWN"))


def futures_suffix(code: ColumnOrName) -> Column:
    """``cu2501`` to ``cu2501.SHF``; a code with a suffix of three stays."""
    c = col(code)
    product = F.lower(F.regexp_replace(c, r"[0-9]+$", ""))
    return F.when(c.rlike(r"^[^.]*\.[^.]{3}$"), c).otherwise(F.concat(c, F.lit("."), lookup(_inverted(FUTURES_SUFFIXES), product, F.lit("SHF"))))


def option_suffix(code: ColumnOrName) -> Column:
    c = col(code)
    return F.when(c.contains("."), c).when(c.rlike(r"^9.{7}$"), F.concat(c, F.lit(".SZSE"))).otherwise(F.concat(c, F.lit(".SSE")))


def third_friday(year: Column, month: Column) -> Column:
    first = F.make_date(year, month, F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "FRI"), 14)


def parse_futures_code(code: ColumnOrName) -> Column:
    """struct(underlying, delivery_month 'yyyyMM', expiry_date: third Friday)."""
    c = col(code)
    pattern = r"^([A-Za-z]+)(\d{4})"
    digits = F.regexp_extract(c, pattern, 2)
    matched = c.rlike(pattern)
    month = F.substring(digits, 3, 2).try_cast("int")
    dated = matched & month.between(1, 12)
    year = F.concat(F.lit("20"), F.substring(digits, 1, 2)).try_cast("int")
    return F.struct(
        F.when(matched, F.regexp_extract(c, pattern, 1)).otherwise(c).alias("underlying"),
        F.when(matched, F.concat(F.lit("20"), digits)).otherwise(F.lit("")).alias("delivery_month"),
        F.when(dated, third_friday(F.when(dated, year), F.when(dated, month))).alias("expiry_date"),
    )


def parse_option_code(code: ColumnOrName, year: int | Column) -> Column:
    """struct(underlying, option_type, strike_price, expiry_date). ``year``: that of
    the expiry, which the code doesn't have; the day is the 28th."""
    c = col(code)
    pattern = r"(?i)^(.+?)(购|沽|call|put)(\d+月)?(\d+)"
    matched = c.rlike(pattern)
    kind = F.lower(F.regexp_extract(c, pattern, 2))
    digits = F.regexp_extract(c, pattern, 4)
    strike = digits.try_cast("double")
    month = F.regexp_replace(F.regexp_extract(c, pattern, 3), "月", "").try_cast("int")
    y = F.lit(year) if isinstance(year, int) else year
    return F.struct(
        F.when(matched, F.regexp_extract(c, pattern, 1)).otherwise(c).alias("underlying"),
        F.when(matched & kind.isin("沽", "put"), "put").otherwise("call").alias("option_type"),
        F.when(matched, F.when(F.length(digits) >= 4, strike / 1000.0).otherwise(strike)).otherwise(F.lit(0.0)).alias("strike_price"),
        F.when(matched & month.between(1, 12), F.make_date(y, F.when(month.between(1, 12), month), F.lit(28))).alias("expiry_date"),
    )


OPTION_TYPES = {"认购": "call", "认沽": "put"}  # fixed values


def option_type(c: ColumnOrName) -> Column:
    return lookup(OPTION_TYPES, col(c))


# --- dates ------------------------------------------------------------------------------


def iso_date(c: ColumnOrName) -> Column:
    return F.to_date(col(c).cast("string"))


def compact_date(c: ColumnOrName) -> Column:
    return F.to_date(col(c).cast("string"), "yyyyMMdd")


def lenient_date(c: ColumnOrName) -> Column:
    """Null where it can't be read."""
    return F.try_to_timestamp(col(c).cast("string")).cast("date")
