"""Names, keys and durations: validity as expressions, parsing on the driver."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed formats.
MODEL_NAME = r"^[a-zA-Z0-9][\w\-.]{0,63}$"
PARTITION_FILE = r"[0-9]{8}T[0-9]{6}Z-[0-9]{8}T[0-9]{6}Z-[0-9]+-.{36}\.parquet"
PARTITION_KEY = (
    r"^rewarded_decisions/[a-zA-Z0-9][\w\-.]{0,63}/parquet/[0-9]{4}/[0-9]{2}/[0-9]{2}/" + PARTITION_FILE
)
UNITS = ("second", "minute", "hour", "day")


def is_model_name(name: Column) -> Column:
    """1 to 64 word characters, dots or dashes, the first an ASCII letter or digit."""
    return F.coalesce(name.rlike("(?U)" + MODEL_NAME.replace("$", r"\z")), F.lit(False))


def is_partition_key(key: Column) -> Column:
    return F.coalesce(key.rlike("(?U)" + PARTITION_KEY), F.lit(False))


def file_facts(path: Column) -> dict[str, Column]:
    """max_ts, min_ts, row_count from a partition file's name (null where it has none)."""
    pattern = r"([0-9]{8}T[0-9]{6}Z)-([0-9]{8}T[0-9]{6}Z)-([0-9]+)-.{36}\.parquet$"
    part = lambda k: F.nullif(F.regexp_extract(path, pattern, k), F.lit(""))
    return {"max_ts": part(1), "min_ts": part(2), "row_count": part(3).cast("long")}


def parse_duration(text: str) -> timedelta:
    """``"24 hours"`` and the like: a number and a unit from seconds to days."""
    value, unit = re.sub(r"\s+", " ", text.strip()).split(" ")
    if unit.removesuffix("s") not in UNITS or unit.endswith("ss"):
        raise ValueError(f"unknown unit in {text!r}")
    return timedelta(**{unit.removesuffix("s") + "s": float(value)})


def _value_and_unit(text: str) -> tuple[str, str]:
    parts = str(text or "").split()
    if len(parts) != 2:
        raise ValueError(f"not a value and a unit: {text!r}")
    return parts[0], parts[1]


def parse_runtime(text: str) -> int:
    """Seconds of ``"2 hours"``: a positive whole number of seconds, minutes, hours or days."""
    value, unit = _value_and_unit(text)
    if not re.fullmatch("[1-9][0-9]*", value) or unit.lower() not in [f"{u}s" for u in UNITS]:
        raise ValueError(f"not a runtime: {text!r}")
    return int(timedelta(**{unit.lower(): int(value)}).total_seconds())


def parse_volume(text: str) -> int:
    """Gigabytes of ``"10 GB"``, a positive whole number."""
    value, unit = _value_and_unit(text)
    if unit != "GB" or float(value) != int(float(value)) or float(value) <= 0:
        raise ValueError(f"not a volume: {text!r}")
    return int(float(value))


def parse_flag(text: str) -> bool:
    """yes, true, t or 1 in any case."""
    return str(text).lower() in ("yes", "true", "t", "1")


def job_name(parts: list[str], started: datetime, limit: int = 63, least: tuple[int, ...] = (0, 4, 8)) -> str:
    """``service-stage-model-time`` of letters, digits and dashes, at most ``limit`` long.

    Room beyond the least lengths of stage and model is shared evenly between them; only
    if there is none is the service name cut.
    """
    service, stage, model = parts
    stamp = re.sub(r"[-:. ]", "", str(started).split(".")[0])
    clean = lambda xs: re.sub("[^A-Za-z0-9-]", "-", "-".join(x for x in xs if x))
    whole = clean([service, stage, model, stamp])
    if len(whole) <= limit:
        return whole
    fixed = len(stamp) + sum(1 for x in (service, stage, model) if x)
    room = limit - fixed - len(service) - (least[1] if stage else 0) - least[2]
    if room < 0:
        service, room = service[:room], 0
    for_stage = min(max(0, len(stage) - least[1]), room // 2) if stage else 0
    return clean([service, stage[: least[1] + for_stage], model[: least[2] + room - for_stage], stamp])[:limit]
