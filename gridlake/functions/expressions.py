"""Column expressions that the market models share. All of them stay in generated code; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "Asia/Istanbul"

#: Labels of the published tables.
DEFICIT, SURPLUS, BALANCED = "ENERGY_DEFICIT", "ENERGY_SURPLUS", "IN_BALANCE"
DIRECTION_LABELS = {"Enerji Açığı": DEFICIT, "Enerji Fazlası": SURPLUS, "Dengede": BALANCED}
SEASONS = {"Kış": (12, 1, 2), "İlkbahar": (3, 4, 5), "Yaz": (6, 7, 8)}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def zero(c: str | Column) -> Column:
    """The value, 0 for null."""
    return F.coalesce(col(c), F.lit(0.0))


def total(*columns: str) -> Column:
    return reduce(lambda a, b: a + b, map(zero, columns))


def strict_greatest(*columns: Column) -> Column:
    """The greatest value; null if any is null."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in columns]), F.greatest(*columns))


def strict_least(*columns: Column) -> Column:
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in columns]), F.least(*columns))


def local(instant: str | Column) -> Column:
    """Istanbul wall-clock time of a UTC instant."""
    return F.from_utc_timestamp(col(instant), ZONE)


def local_date(instant: str | Column) -> Column:
    return F.to_date(local(instant))


def local_hour(instant: str | Column) -> Column:
    return F.hour(local(instant))


def text_hour(c: str | Column) -> Column:
    """The hour of ``HH:mm`` text; null if it has none."""
    return F.substring(col(c).cast("string"), 1, 2).try_cast("int")


def instant_of(date: str | Column = "date", hour: str | Column = "hour") -> Column:
    """The UTC instant at which an Istanbul (date, hour) begins."""
    return F.to_utc_timestamp(col(date).cast("timestamp"), ZONE) + F.make_dt_interval(hours=col(hour).cast("int"))


def season(date: str | Column) -> Column:
    out = F
    for name, months in SEASONS.items():
        out = out.when(F.month(col(date)).isin(*months), F.lit(name))
    return out.otherwise(F.lit("Sonbahar"))


def price_block(hour: str | Column) -> Column:
    return F.when(col(hour).between(17, 21), "Puant").when(col(hour).between(6, 16), "Gündüz").otherwise("Gece")


def deficit_price(ptf: Column, smf: Column, premium: float = 1.03) -> Column:
    """What a short party pays: the dearer of both prices and a premium; a missing balancing price counts as the other."""
    return strict_greatest(ptf, F.coalesce(smf, ptf)) * premium


def surplus_price(ptf: Column, smf: Column, discount: float = 0.97) -> Column:
    return strict_least(ptf, F.coalesce(smf, ptf)) * discount


def weighted_price(price: str = "price_try", quantity: str = "quantity_mwh") -> Column:
    """Volume-weighted average price as an aggregate; null without volume."""
    return ratio(F.sum(col(price) * col(quantity)), F.sum(quantity))


def normal_pdf(z: Column) -> Column:
    return F.exp(-z * z / 2) / F.sqrt(F.lit(2.0) * F.pi())


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution by the rational approximation 7.1.26 of Abramowitz and Stegun (error below 2e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - poly * F.exp(-x * x)
    return F.when(z >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def expected_max(mu: Column, sigma: Column, bound: Column) -> Column:
    """E[max(X, bound)] of a normal X; without spread the larger of mean and bound."""
    z = ratio(mu - bound, sigma)
    return F.when(sigma > 0, bound + (mu - bound) * normal_cdf(z) + sigma * normal_pdf(z)).otherwise(F.greatest(mu, bound))


def expected_min(mu: Column, sigma: Column, bound: Column) -> Column:
    return mu + bound - expected_max(mu, sigma, bound)


def recency_weight(age_days: str | Column, half_life: float = 90.0) -> Column:
    return F.pow(F.lit(0.5), col(age_days) / half_life)


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """All double columns rounded, so that sums in another order compare equal."""
    return df.select(*[F.round(c, places).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
