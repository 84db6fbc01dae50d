"""Problem 1: one quantity recorded in different units, stated or not.

Each recorded value gets every reading it allows: the unit that its text states, or, where
it states none, every unit known for the quantity; and both readings of a comma that may
part thousands or decimals. Physical identities between columns (an area is the area of the
footprint, power is power density times area, or module power times modules) predict the
logarithm of the value in the common unit. Of all combinations of readings of the row's
quantities the one with the least sum of squared residuals, each over the identity's spread,
is kept; a solution is flagged as not unique if another combination that means another value
comes within ``MARGIN`` of it.

Densities are not constants: they are the corpus medians of rows that state both sides.

Everything is a JVM expression over one scan, without a join; the footprint's area is the
only Arrow column. One aggregate of a few medians precedes it.

Defined results: null values have no row; values without a number keep unit '' and a null
value; with no identity to test, a bare value counts as in the field's own unit and is
flagged as not unique; zero and negative values keep their own unit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cost of a unit other than the field's own where none is stated, in squared spreads.
PRIOR = 4.0
#: Cost of reading a single comma as one that parts thousands.
THOUSANDS = 1.0
#: Least distance in cost to the next combination for a unique solution.
MARGIN = 4.0

#: Unit, its size in the common unit, and the spellings that state it.
POWER_MW = {
    "GW": (1e3, ("gw", "gwp", "gigawatt", "gigawatts")),
    "MW": (1.0, ("mw", "mwp", "megawatt", "megawatts")),
    "kW": (1e-3, ("kw", "kwp", "kilowatt", "kilowatts")),
    "W": (1e-6, ("w", "wp", "watt", "watts")),
}
AREA_M2 = {
    "km2": (1e6, ("km²", "km2", "sq km", "sqkm", "square kilometres", "square kilometers")),
    "ha": (1e4, ("ha", "hectare", "hectares")),
    "acre": (4046.8564224, ("ac", "acre", "acres")),
    "m2": (1.0, ("m²", "m2", "sqm", "sq m", "square metres", "square meters")),
    "yd2": (0.83612736, ("yd²", "yd2", "sq yd", "square yards")),
    "ft2": (0.09290304, ("ft²", "ft2", "sq ft", "sqft", "square feet")),
    "cm2": (1e-4, ("cm²", "cm2", "sq cm", "square centimetres")),
}


@dataclass(frozen=True)
class Identity:
    """log10(quantity in the common unit) is about ``log_reference`` plus a constant.

    ``spread`` is the standard deviation of the residual in log10. ``calibrate`` names a
    column expression with samples of the constant, whose corpus median is then used.
    """

    name: str
    log_reference: Column
    spread: float
    calibrate: Column | None = None


@dataclass(frozen=True)
class Quantity:
    """A column, its units (name -> size in the common unit, as a column) and its identities."""

    name: str
    column: str
    own: str
    units: dict[str, Column]
    spellings: dict[str, tuple[str, ...]] = field(default_factory=dict)
    identities: tuple[Identity, ...] = ()
    #: With another quantity: (its name, log10 of self minus log10 of it, spread, calibration)
    ties: tuple[tuple[str, float, Column], ...] = ()


def log10_positive(c: Column) -> Column:
    """log10 where the argument is a positive number, else null."""
    d = c.cast("double")
    return F.when((d > 0) & ~F.isnan(d) & (d < 1e300), F.log10(d))


def _readings(number: Column) -> Column:
    """Values that the digits may mean, most likely first, each with its cost."""
    comma, dot = number.contains(","), number.contains(".")
    plain = F.regexp_replace(number, "[,']", "")
    last_comma = F.length(number) - F.length(F.substring_index(number, ",", -1)) > F.length(number) - F.length(F.substring_index(number, ".", -1))
    both = F.when(last_comma, F.regexp_replace(F.regexp_replace(number, "[.']", ""), ",", ".")).otherwise(plain)
    grouped = number.rlike(r"^[-+]?[1-9]\d{0,2}(,\d{3}){2,}$")
    maybe = number.rlike(r"^[-+]?[1-9]\d{0,2},\d{3}$")
    dots = number.rlike(r"^[-+]?\d{1,3}(\.\d{3}){2,}$")
    value = lambda text, cost: F.struct(F.expr("0.0").cast("double").alias("cost") if cost == 0 else F.lit(cost).alias("cost"), text.try_cast("double").alias("value"))
    decimal = F.regexp_replace(number, ",", ".")
    return (
        F.when(comma & dot, F.array(value(both, 0)))
        .when(grouped, F.array(value(plain, 0)))
        .when(maybe, F.array(value(decimal, 0), value(plain, THOUSANDS)))
        .when(comma, F.array(value(decimal, 0)))
        .when(dots, F.array(value(F.regexp_replace(number, r"\.", ""), 0)))
        .otherwise(F.array(value(number, 0)))
    )


def parse_text(text: Column, spellings: dict[str, tuple[str, ...]]) -> tuple[Column, Column]:
    """(readings of the number, stated unit or '') of a text such as ``about 9.9 kW peak`` or ``12 x 283 W``."""
    t = F.lower(F.trim(F.regexp_replace(text, r"[    \s]+", " ")))
    product = r"^\D*?(\d+(?:\.\d+)?)\s*[x×*]\s*(\d+(?:\.\d+)?)"
    number = r"([-+]?(?:\d[\d.,']*\d|\d)(?:e[-+]?\d+)?)"
    a, b = F.regexp_extract(t, product, 1).try_cast("double"), F.regexp_extract(t, product, 2).try_cast("double")
    # a number that ends a unit (m2, ft2) is no quantity: the first number not after a letter is
    digits = F.regexp_extract(t, r"(?:^|[^a-z0-9.,])" + number, 1)
    readings = F.when((a * b).isNotNull(), F.array(F.struct(F.lit(0.0).alias("cost"), (a * b).alias("value")))).otherwise(_readings(digits))
    names = {s: u for u, all_ in spellings.items() for s in all_}
    pattern = "|".join(sorted(names, key=lambda s: (-len(s), s)))
    said = F.regexp_extract(t, rf"(?:^|[^a-z])({pattern})(?:$|[^a-z0-9²])", 1) if names else F.lit("")
    said = F.when(said == "", F.regexp_extract(t, rf"\d({pattern})(?:$|[^a-z0-9²])", 1)).otherwise(said) if names else said
    unit = F.lit("")
    for u, all_ in spellings.items():
        unit = F.when(said.isin(*all_), F.lit(u)).otherwise(unit)
    return readings, unit


def _candidates(q: Quantity, readings: Column, unit: Column) -> Column:
    """Array of (unit, log10 of the value in the common unit, cost of the reading)."""
    sizes = F.array(*[F.struct(F.lit(u).alias("unit"), log10_positive(size).alias("log_size")) for u, size in q.units.items()])
    allowed = F.filter(sizes, lambda s: (unit == "") | (s["unit"] == unit))
    bare = unit == ""

    def of(s: Column) -> Column:
        return F.transform(
            readings,
            lambda r: F.struct(
                s["unit"].alias("unit"),
                (log10_positive(r["value"]) + s["log_size"]).alias("log"),
                (r["cost"] + F.when(bare & (s["unit"] != q.own), PRIOR).otherwise(0.0)).alias("cost"),
                r["value"].alias("number"),
            ),
        )

    return F.flatten(F.transform(allowed, of))


def reconcile(df: DataFrame, quantities: list[Quantity], key: str, keep: list[str] | None = None) -> DataFrame:
    """One row per non-null value: ``key, field_name, unit, value, residual, is_own, is_unique``.

    ``value`` is in the common unit, ``residual`` the root of the kept combination's cost over
    the number of identities that could be tested.
    """
    keep = keep or []
    # corpus medians of the identities' constants, in one small aggregate
    medians, samples = {}, {}
    for q in quantities:
        for i in q.identities:
            if i.calibrate is not None:
                samples[f"{q.name}|{i.name}"] = i.calibrate
        for other, _, sample in q.ties:
            samples[f"{q.name}~{other}"] = sample
    if samples:
        row = df.select(*[c.alias(f"s{n}") for n, c in enumerate(samples.values())]).agg(*[F.percentile_approx(f"s{n}", 0.5, 1000).alias(f"s{n}") for n in range(len(samples))]).first()
        medians = dict(zip(samples, row))

    work = df
    for q in quantities:
        c = F.col(f"`{q.column}`")
        if dict(df.dtypes)[q.column] == "string":
            readings, unit = parse_text(c, q.spellings)
        else:
            readings, unit = F.array(F.struct(F.lit(0.0).alias("cost"), c.cast("double").alias("value"))), F.lit("")
        work = work.withColumns({f"__r_{q.name}": readings, f"__u_{q.name}": unit})
    for q in quantities:
        found = _candidates(q, F.col(f"__r_{q.name}"), F.col(f"__u_{q.name}"))
        nothing = F.array(F.struct(F.lit(None).cast("string").alias("unit"), F.lit(None).cast("double").alias("log"), F.lit(0.0).alias("cost"), F.lit(None).cast("double").alias("number")))
        work = work.withColumn(f"__c_{q.name}", F.when(F.col(f"`{q.column}`").isNull() | (F.size(found) <= 0), nothing).otherwise(found))
        refs = [(i.log_reference + F.lit(float(medians.get(f"{q.name}|{i.name}", 0.0) or 0.0)), i.spread) for i in q.identities if i.calibrate is None or medians.get(f"{q.name}|{i.name}") is not None]
        work = work.withColumn(f"__i_{q.name}", F.array(*[F.struct(r.alias("ref"), F.lit(s).alias("spread")) for r, s in refs]) if refs else F.expr("CAST(array() AS array<struct<ref:double,spread:double>>)"))

    def misfit(q: Quantity, cand: Column) -> Column:
        return F.aggregate(F.col(f"__i_{q.name}"), F.lit(0.0), lambda acc, i: acc + F.coalesce(F.pow((cand["log"] - i["ref"]) / i["spread"], 2), F.lit(0.0)))

    def costed(q: Quantity) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["unit"].alias("unit"), x["log"].alias("log"), (x["cost"] + misfit(q, x)).alias("cost"), x["number"].alias("number"))

    # each candidate's own cost once, then all combinations
    for q in quantities:
        work = work.withColumn(f"__c_{q.name}", F.transform(f"__c_{q.name}", costed(q)))

    def joined(q: Quantity, before: list[Quantity]) -> Callable[[Column], Column]:
        def with_all(c: Column) -> Column:
            def with_one(x: Column) -> Column:
                cost = c["cost"] + x["cost"]
                for p in before:
                    for a, b, sign in ((q, p, 1.0), (p, q, -1.0)):
                        for other, spread, _ in a.ties:
                            middle = medians.get(f"{a.name}~{other}")
                            if other == b.name and middle is not None:
                                cost = cost + F.coalesce(F.pow(((x["log"] - c[p.name]["log"]) * sign - float(middle)) / spread, 2), F.lit(0.0))
                return F.struct(cost.alias("cost"), *[c[p.name].alias(p.name) for p in before], x.alias(q.name))

            return F.transform(F.col(f"__c_{q.name}"), with_one)

        return with_all

    first = quantities[0]
    combos = F.transform(f"__c_{first.name}", lambda x: F.struct(x["cost"].alias("cost"), x.alias(first.name)))
    work = work.withColumn("__combos", combos)
    for n, q in enumerate(quantities[1:], 1):
        work = work.withColumn("__combos", F.flatten(F.transform("__combos", joined(q, quantities[:n]))))
    work = work.withColumn("__best", F.array_min("__combos"))

    def rival(q: Quantity, best: Column) -> Callable[[Column], Column]:
        return lambda c: (c["cost"] < F.col("__best.cost") + MARGIN) & (F.abs(c[q.name]["log"] - best["log"]) > 0.01)

    shown = []
    for q in quantities:
        best = F.col(f"__best.{q.name}")
        # another meaning of this field within the margin; readings that mean the same value don't count
        near = F.exists("__combos", rival(q, best))
        tested = F.aggregate(F.col(f"__i_{q.name}"), F.lit(0), lambda acc, i: acc + F.when(i["ref"].isNotNull(), 1).otherwise(0))
        shown.append(
            F.struct(
                F.lit(q.column).alias("field_name"),
                F.coalesce(best["unit"], F.lit("")).alias("unit"),
                F.when(best["log"].isNotNull(), F.pow(F.lit(10.0), best["log"])).otherwise(best["number"]).alias("value"),
                F.sqrt(F.col("__best.cost") / F.greatest(tested, F.lit(1))).alias("residual"),
                F.coalesce(best["unit"] == q.own, F.lit(True)).alias("is_own"),
                (~F.coalesce(near, F.lit(False)) & ((tested > 0) | (F.col(f"__u_{q.name}") != ""))).alias("is_unique"),
                F.col(f"`{q.column}`").isNotNull().alias("given"),
            )
        )
    out = work.select(F.col(f"`{key}`"), *[F.col(f"`{k}`") for k in keep], F.explode(F.array(*shown)).alias("__v")).filter("__v.given")
    return out.select(F.col(f"`{key}`"), *[F.col(f"`{k}`") for k in keep], "__v.field_name", "__v.unit", "__v.value", "__v.residual", "__v.is_own", "__v.is_unique")
