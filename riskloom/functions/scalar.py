"""Column expressions.  All stay inside whole-stage code generation; no UDFs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import settings as S

MICROS = 1_000_000


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("smallint")


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts).cast("smallint")


def is_night(hour: Column) -> Column:
    return ((hour >= 22) | (hour <= 2)).cast("tinyint")


def cyclic_hour(hour: Column) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi) * hour.cast("double") / F.lit(24.0)
    return F.sin(angle), F.cos(angle)


def age_years(ts: Column, birth_date: Column) -> Column:
    """Years between birth and the event; an unreadable birth date gives null."""
    born = F.try_to_timestamp(birth_date.cast("string"))
    micros = (epoch_micros(ts) - epoch_micros(born)).cast("double")
    return micros / F.lit(MICROS * S.SECONDS_PER_YEAR)


def age_whole_days(ts: Column, birth_date: Column) -> Column:
    """The exploratory variant: whole elapsed days over 365.25."""
    born = F.try_to_timestamp(birth_date.cast("string"))
    days = F.floor((F.unix_seconds(ts.cast("timestamp")) - F.unix_seconds(born)) / F.lit(86400.0))
    return days.cast("double") / F.lit(365.25)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null when any coordinate is null."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2.0)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    # least/greatest skip nulls, so the clip must not run on a null distance.
    clipped = F.when(a.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), a)))
    return F.lit(2.0 * S.EARTH_RADIUS_KM) * F.asin(F.sqrt(clipped))


def speed_kmh(km: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, km / (seconds / F.lit(3600.0)))


def cut_right_closed(value: Column, buckets: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the ``(low, high]`` bucket that holds the value, null outside all."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(buckets):
        out = F.when((value > low) & (value <= high), F.lit(label)).otherwise(out)
    return out


def _edge_search(value: Column, edges: Sequence[float], offset: int, closed_left: bool) -> Column:
    if not edges:
        return F.lit(offset)
    mid = len(edges) // 2
    passed = value >= F.lit(edges[mid]) if closed_left else value > F.lit(edges[mid])
    above = _edge_search(value, edges[mid + 1:], offset + mid + 1, closed_left)
    return F.when(passed, above).otherwise(_edge_search(value, edges[:mid], offset, closed_left))


def digitize(value: Column, edges: Sequence[float]) -> Column:
    """Number of ascending edges at or below the value (an equal value moves up).

    A balanced tree of comparisons: about log2(edges) per row.
    """
    return F.when(value.isNotNull(), _edge_search(value, list(edges), 0, True))


def bins_right_closed(value: Column, edges: Sequence[float]) -> Column:
    """Number of ascending edges strictly below the value (an equal value stays down)."""
    return F.when(value.isNotNull(), _edge_search(value, list(edges), 0, False))


def linear_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1 over [low, high]; the last bin is closed, outside is null."""
    position = F.floor((value - low) / (high - low) * F.lit(float(bins)))
    return F.when((value >= low) & (value <= high), F.least(position, F.lit(bins - 1)).cast("int"))


def age_group(age: Column) -> Column:
    return F.when(age < 30, "<30").when(age < 50, "30-50").when(age >= 50, "50+")


def clip_logit(p: Column, eps: float = S.LOGIT_CLIP) -> Column:
    clipped = F.when(p.isNotNull(), F.least(F.lit(1.0 - eps), F.greatest(F.lit(eps), p)))
    return F.log(clipped / (F.lit(1.0) - clipped))


def decision(score: Column, threshold: float) -> Column:
    return F.struct(
        F.lit(float(threshold)).alias("threshold"),
        (score >= F.lit(float(threshold))).alias("is_fraud"),
    )


def lift_over_base(calibrated: Column, base_rate: float = S.PUBLISHED_BASE_RATE) -> Column:
    return calibrated / F.lit(base_rate) if base_rate > 0 else F.lit(0.0)


def scale_clip(score: Column, low: float = S.DISPLAY_RANGE[0], high: float = S.DISPLAY_RANGE[1]) -> Column:
    scaled = (score - F.lit(low)) / F.lit(high - low)
    return F.when(score.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)))


def decision_correct(is_fraud: Column, label: Column) -> Column:
    return is_fraud == (label == 1)


def contribution_direction(contribution: Column) -> Column:
    return F.when(contribution >= 0, "increases_fraud").otherwise("decreases_fraud")


def decision_band(calibrated: Column, approve_below: float = S.APPROVE_BELOW, block_from: float = S.BLOCK_FROM) -> Column:
    """approve / pending_review / block; a missing score (model down) goes to review."""
    return (
        F.when(calibrated.isNull(), "pending_review")
        .when(calibrated < F.lit(approve_below), "approve")
        .when(calibrated >= F.lit(block_from), "block")
        .otherwise("pending_review")
    )


def reason_code(band: Column) -> Column:
    return (
        F.when(band == "approve", "auto_approve").when(band == "block", "auto_block").otherwise("manual_review")
    )


def half_month(ts: Column) -> Column:
    """Period key of the twice-monthly report: days 1-15 and 16-end."""
    return F.concat(F.date_format(ts, "yyyy-MM"), F.when(F.dayofmonth(ts) <= 15, "-A").otherwise("-B"))


def times_sentence(value: Column, usual: Column, at_least: float, template: str) -> Column:
    """``template`` with how many times the usual value this one is; null below ``at_least`` and where a part is missing, NaN or not positive."""
    times = value / F.when(usual > 0, usual)
    said = F.replace(F.lit(template), F.lit("%s"), F.format_number(times, 1))
    return F.when((times >= F.lit(float(at_least))) & (times < F.lit(math.inf)), said)


def flag_sentence(flag: Column, text: str) -> Column:
    """``text`` where the flag is one, else null."""
    return F.when(flag == 1, F.lit(text))


def fold_of(tx_id: Column, folds: int = S.ENCODING_FOLDS) -> Column:
    """Deterministic fold by multiplicative hashing of the row id: (id * 2654435761 mod 2^32) mod folds.

    The product is taken in two halves of the multiplier so that no 64-bit id overflows.
    """
    modulus = F.lit(2**32)
    reduced = F.pmod(tx_id.cast("bigint"), modulus)
    high, low = divmod(2654435761, 2**16)
    hashed = F.pmod(F.pmod(reduced * F.lit(high), modulus) * F.lit(2**16) + reduced * F.lit(low), modulus)
    return (hashed % folds).cast("int")


def hash_order(tx_id: Column, seed: int = 42) -> Column:
    """Repeatable shuffle key: same rows and seed give the same order in any engine."""
    prime = F.lit(2**31 - 1)
    mixed = F.pmod(F.pmod(tx_id.cast("bigint"), prime) * F.lit(48271) + F.lit(seed * 7919), prime)
    return F.pmod(mixed * F.lit(69621), prime)


def canary_bucket(card: Column, percent: int = 5) -> Column:
    """Route a fixed share of cards to the candidate model, the same cards every time."""
    slot = F.pmod(F.pmod(card.cast("bigint"), F.lit(1_000_003)) * F.lit(7919), F.lit(100))
    return F.when(slot < percent, "canary").otherwise("stable")
