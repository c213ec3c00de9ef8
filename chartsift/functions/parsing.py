"""Dirty cells to typed values: each function takes a string column and gives a column, NULL where it can't tell.

Canonical units: V, A, mOhm, pF, nC, W, mJ, ns, C/W, USD, degrees C. Everything stays in built-in expressions, so a whole
ingest is one narrow projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that count as empty, and the number that a cell may begin with.
EMPTY = ("", "-", "N/A", "n/a", "null", "None")
NUMBER = r"([+-]?\d+\.?\d*)"
_FLOAT = r"^[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_PLAIN = r"^(\d+\.?\d*|\.\d+)$"  # asked before a cast of what may be no number, which would cost an exception a row

# Target unit -> source unit -> factor.
UNIT_FACTORS = {
    "mOhm": {"ohm": 1000.0, "Ω": 1000.0, "℧": 1000.0, "mohm": 1.0, "milliohm": 1.0, "mili ohm": 1.0, "miliohm": 1.0, "mΩ": 1.0, "m℧": 1.0, "uohm": 0.001, "microohm": 0.001, "µΩ": 0.001, "uΩ": 0.001, "µ℧": 0.001},
    "Ohm": {"ohm": 1.0, "Ω": 1.0, "℧": 1.0, "mohm": 0.001, "mΩ": 0.001, "m℧": 0.001, "milliohm": 0.001},
    "pF": {"pf": 1.0, "nf": 1000.0, "µf": 1e6, "uf": 1e6, "ff": 0.001},
    "nC": {"nc": 1.0, "pc": 0.001, "µc": 1000.0, "uc": 1000.0},
    "V": {"v": 1.0, "mv": 0.001, "kv": 1000.0},
    "A": {"a": 1.0, "ma": 0.001},
    "C/W": {"°c/w": 1.0, "ºc/w": 1.0, "c/w": 1.0, "k/w": 1.0},
    "mJ": {"mj": 1.0, "j": 1000.0, "µj": 0.001, "uj": 0.001},
    "USD": {"usd": 1.0, "$": 1.0, "": 1.0},
    "ns": {"ns": 1.0, "us": 1000.0, "µs": 1000.0, "ms": 1e6, "s": 1e9, "ps": 0.001},
    "W": {"w": 1.0, "mw": 0.001, "kw": 1000.0},
    "S": {"s": 1.0, "ms": 0.001},
}


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once a row, however often it is used: an expression that stands in several branches is computed
    in each."""
    return F.get(F.transform(F.array(c), use), 0)


def as_double(c: Column) -> Column:
    """A float literal as a double; anything else, infinities and NaN included, is NULL."""
    return _once(F.trim(c), lambda t: F.when(t.rlike(_FLOAT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double")))


def cell(c: Column) -> Column:
    """The trimmed cell, NULL if it counts as empty."""
    t = F.trim(c)
    return F.when(~t.isin(*EMPTY), t)


def clean_string(c: Column) -> Column:
    """A trimmed text field; blank and ``-`` are NULL."""
    t = F.trim(c)
    return F.when(~t.isin("", "-"), t)


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match as a double, NULL without a match."""
    return _once(F.regexp_extract(c, pattern, group), lambda m: F.when(m != "", m.try_cast("double")))


def _scaled(s: Column, symbol: str, factors: dict[str, Callable[[Column], Column]], otherwise: Callable[[Column], Column] | None = None) -> Column:
    """The number that ``s`` begins with, by what the letter before the unit's ``symbol`` says (``""``: no letter); one search finds
    number and unit, since a number can be followed by one unit only."""
    letters = "".join(factors)
    unit = f"[{letters}]{'?' if '' in factors else ''}{symbol}"

    def value(m: Column) -> Column:
        number, letter, out = F.rtrim(m, F.lit(f"{letters}{symbol} \t\n\x0b\f\r")).try_cast("double"), F.substring(m, -2, 1), F
        for x, scale in factors.items():
            if x:
                out = out.when(letter == x, scale(number))
        return out.otherwise(factors[""](number)) if "" in factors else out

    def found(s: Column) -> Column:
        return _once(F.regexp_extract(s, "^" + NUMBER + r"\s*" + unit, 0), lambda m: F.when(m != "", value(m)) if otherwise is None else F.when(m != "", value(m)).otherwise(otherwise(s)))

    return _once(s, found)


def numeric(c: Column) -> Column:
    """Units at the end go, of a range the first value counts, conditions after ``@`` and thousands commas go."""
    s = F.regexp_replace(cell(c), r"[VAmWnCpFKSΩ℧°/]+$", "")
    return as_double(F.replace(F.substring_index(F.substring_index(s, "~", 1), "@", 1), F.lit(","), F.lit("")))


def voltage(c: Column) -> Column:
    s = F.trim(F.ltrim(cell(c), F.lit("±")))
    kilo = lambda n: n * 1000.0
    return _scaled(s, "V", {"k": kilo, "K": kilo, "m": lambda n: n / 1000.0, "": lambda n: n}, numeric)


def _ta_first(c: Column, unit: str) -> Column:
    """Of comma-separated parts, the one for ambient temperature (or a single part not for the case), else any."""
    parts = F.transform(F.split(cell(c), ","), lambda p: F.trim(p))
    pattern = "^" + NUMBER + rf"\s*(m?{unit})"

    def value(p: Column) -> Column:
        return F.when(F.regexp_extract(p, pattern, 2) == "m" + unit, _first(p, pattern) / 1000.0).otherwise(_first(p, pattern))

    def first_of(a: Column) -> Column:
        return F.get(F.filter(F.transform(a, value), lambda v: v.isNotNull()), 0)

    preferred = F.filter(parts, lambda p: p.contains("(Ta)") | ((F.size(parts) == 1) & ~p.contains("(Tc)")))
    return F.coalesce(first_of(preferred), first_of(parts))


def current(c: Column) -> Column:
    return _ta_first(c, "A")


def power(c: Column) -> Column:
    return _ta_first(c, "W")


def rdson_mohm(c: Column) -> Column:
    """Micro, milli and plain ohm anywhere in the cell, in this order; a bare number is milliohm already. Text such as
    ``.. mOhm`` is NULL, not an error."""
    micro, milli, plain = (rf"(?iu)([\d.]+)\s*{u}[OΩ℧WQ]" for u in ("[uµ]", "m", ""))

    def first(s: Column, pattern: str, scale: Callable[[Column], Column], otherwise: Callable[[Column], Column]) -> Column:
        return _once(F.regexp_extract(s, pattern, 1), lambda m: F.when(m != "", F.when(m.rlike(_PLAIN), scale(m.try_cast("double")))).otherwise(otherwise(s)))

    return _once(cell(c), lambda s: first(s, micro, lambda n: n / 1000.0, lambda s: first(s, milli, lambda n: n, lambda s: first(s, plain, lambda n: n * 1000.0, numeric))))


def capacitance(c: Column) -> Column:
    million = lambda n: n * 1e6
    return _scaled(cell(c), "F", {"n": lambda n: n * 1000.0, "u": million, "µ": million, "p": lambda n: n * 1.0})


def charge(c: Column) -> Column:
    thousand = lambda n: n * 1000.0
    return _scaled(cell(c), "C", {"n": lambda n: n, "u": thousand, "µ": thousand, "p": lambda n: n / 1000.0})


def energy(c: Column) -> Column:
    s = cell(c)
    return F.coalesce(_first(s, "(?iu)^" + NUMBER + r"\s*mJ"), _first(s, "(?iu)^" + NUMBER + r"\s*[uµ]J") / 1000.0, _first(s, "^" + NUMBER + r"\s*J") * 1000.0, numeric(s))


def timing(c: Column) -> Column:
    s = cell(c)
    return F.coalesce(_first(s, "(?iu)^" + NUMBER + r"\s*[uµ]s") * 1000.0, _first(s, "(?iu)^" + NUMBER + r"\s*ns"), _first(s, "(?iu)^" + NUMBER + r"\s*ps") / 1000.0, numeric(s))


def thermal_resistance(c: Column) -> Column:
    return F.coalesce(_first(cell(c), "^" + NUMBER + r"\s*[°ºK]?\s*[CK]?/?W"), numeric(c))


def price(c: Column) -> Column:
    return as_double(F.replace(F.ltrim(cell(c), F.lit("$")), F.lit(","), F.lit("")))


def temperature_range(c: Column) -> Column:
    """struct(low, high); a single value is the high one."""
    s, both = cell(c), "^" + NUMBER + r"\s*°?\s*C\s*~\s*" + NUMBER + r"\s*°?\s*C"
    low, high = _first(s, both, 1), _first(s, both, 2)
    return F.struct(low.alias("low"), F.coalesce(high, _first(s, "^" + NUMBER + r"\s*°?\s*C")).alias("high"))


def exponent_value(c: Column) -> Column:
    """Powers of ten as axis labels write them: ``10 3``, ``10`` with superscript digits, ``10-2``."""
    s = F.translate(F.trim(c), "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−", "0123456789--")
    superscript = c.rlike("10[⁰¹²³⁴⁵⁶⁷⁸⁹⁻]")
    d = F.coalesce(F.nullif(F.regexp_extract(s, r"^10\s+(-?\d)$", 1), F.lit("")), F.nullif(F.regexp_extract(s, r"^10(-\d)$", 1), F.lit("")), F.when(superscript, F.nullif(F.regexp_extract(s, r"^10(-?\d+)$", 1), F.lit(""))))
    return F.pow(F.lit(10.0), d.try_cast("int"))


def tick_value(c: Column, time_axis: bool = False) -> Column:
    """A tick label: decimal comma, unicode minus, ``10d`` (d 1 to 9) as a power, plain numbers, times with a unit on a
    time axis, ``aEb``, ``10^b`` and ``10-d``."""
    s = F.translate(F.trim(c), "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−,", "0123456789--.")
    power_ = F.pow(F.lit(10.0), F.coalesce(F.nullif(F.regexp_extract(s, r"^10\s*\^?\s*([1-9])$", 1), F.lit("")), F.nullif(F.regexp_extract(s, r"^10\s*\^\s*(-?\d+)$", 1), F.lit("")), F.nullif(F.regexp_extract(s, r"^10(-\d)$", 1), F.lit(""))).try_cast("int"))
    plain = as_double(F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s))
    out = [power_, plain]
    if time_axis:
        unit = F.lower(F.regexp_extract(s, r"(?iu)^" + NUMBER + r"\s*(ns|us|µs|ms|s)$", 2))
        factor = F.when(unit == "ns", 1e-9).when(unit.isin("us", "µs"), 1e-6).when(unit == "ms", 1e-3).when(unit == "s", 1.0)
        out.append(_first(s, r"(?iu)^" + NUMBER + r"\s*(?:ns|us|µs|ms|s)$") * factor)
    return F.coalesce(*out)


def temperature_label(c: Column) -> Column:
    """``TJ = 25 C`` (the degree sign may be missing) or a bare ``25°C`` (it may not)."""
    return F.coalesce(_first(c, r"(?i)T_?\s*J\s*=\s*([+-]?\d+\.?\d*)\s*°?\s*C"), _first(c, r"([+-]?\d+\.?\d*)\s*°\s*C"))


#: Canonical field -> parser; ``Tjmax`` fans out to two columns.
PARSERS = {
    **dict.fromkeys(("Vdss", "Vgs_th", "Vgs_max", "Vf", "Vce_sat"), voltage),
    **dict.fromkeys(("Id", "Id_pulse", "Is"), current),
    "Rdson": rdson_mohm,
    **dict.fromkeys(("Qg", "Qgs", "Qgd", "Qrr"), charge),
    **dict.fromkeys(("Ciss", "Coss", "Crss"), capacitance),
    "Pd": power,
    **dict.fromkeys(("R_theta_JC", "R_theta_JA"), thermal_resistance),
    "Cost": price,
    **dict.fromkeys(("eon_ref", "eoff_ref"), energy),
    **dict.fromkeys(("td_on", "td_off", "tr", "tf", "trr"), timing),
    "stock_available": numeric,
}


def unit_table(spark):
    """``(target, source, factor)``: the conversion rules as rows; under a hundred, so made to be broadcast."""
    return spark.createDataFrame([(t, s, f) for t, own in UNIT_FACTORS.items() for s, f in own.items()], "target string, source string, factor double")


def normalize_units(df, value: str, source: str, target: str, out: str = "normalized"):
    """``df`` with ``value`` turned from its ``source`` unit to the unit named by column ``target``.

    The source unit is looked up as it stands, then in lower case; an unknown one gives NULL. A target that no rule
    knows is a mistake in the call, not in the data, and raises when it is met.
    """
    rules = F.broadcast(unit_table(df.sparkSession))
    exact, lower = (rules.select(F.col("target").alias(f"t{i}"), F.col("source").alias(f"s{i}"), F.col("factor").alias(f"f{i}")) for i in (1, 2))
    unit = F.trim(F.col(source))
    joined = df.join(exact, (F.col(target) == F.col("t1")) & (unit == F.col("s1")), "left").join(lower, (F.col(target) == F.col("t2")) & (F.lower(unit) == F.col("s2")), "left")
    checked = F.when(F.col(target).isin(*UNIT_FACTORS), F.col(value) * F.coalesce("f1", "f2")).when(F.col(target).isNotNull(), F.raise_error(F.concat(F.lit("unknown target unit: "), F.col(target))).cast("double"))
    return joined.withColumn(out, checked).drop("t1", "s1", "f1", "t2", "s2", "f2")
