"""Scalar column expressions, all evaluated in the JVM: no Python UDFs.  Array lambdas (``transform``,
``filter``) run outside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
ROUTE_SEPARATOR = "-"
DELAY_SPLITS = [float("-inf"), -15.0, 0.0, 30.0, float("inf")]
ARTIFACT_SUFFIX = "bin"
RUN_ID_UNSAFE = ":+"
RUN_ID_SAFE = "__"
SHORT_NAME_LEN = 8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def route(origin="Origin", dest="Dest") -> Column:
    """``Origin-Dest``; null when either side is null (concat semantics)."""
    return F.concat(_c(origin), F.lit(ROUTE_SEPARATOR), _c(dest))


def delay_class(delay="ArrDelay") -> Column:
    """Delay class as double, with the bucketizer's edge semantics.

    (-inf,-15) -> 0, [-15,0) -> 1, [0,30) -> 2, [30,inf) -> 3; null stays null.
    Negative zero lands in class 1 as it does in a split search over doubles,
    and NaN raises, as the bucketizer does with ``handleInvalid='error'``.
    """
    d = _c(delay)
    neg_zero = (d == 0.0) & F.startswith(d.cast("string"), F.lit("-"))
    return (F.when(d.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(d), F.raise_error(F.lit("delay class: NaN delay")).cast("double"))
            .when(d < DELAY_SPLITS[1], F.lit(0.0))
            .when((d < DELAY_SPLITS[2]) | neg_zero, F.lit(1.0))
            .when(d < DELAY_SPLITS[3], F.lit(2.0))
            .otherwise(F.lit(3.0)))


def date_features(date_col) -> dict[str, Column]:
    """Day of year / month / week (Monday = 0) of a date or ISO date text; text that is
    not a date gives nulls (no error, ANSI mode or not)."""
    d = F.try_to_date(_c(date_col).cast("string"))
    return {
        "DayOfYear": F.dayofyear(d).cast("int"),
        "DayOfMonth": F.dayofmonth(d).cast("int"),
        "DayOfWeek": F.weekday(d).cast("int"),
    }


def parse_model_ids(text="model_ids") -> Column:
    """Requested model ids from the list text.

    Strip one leading ``[`` and one trailing ``]``, split on commas, trim (every
    character up to U+0020, as JVM ``String.trim`` does), drop double quotes,
    keep non-empty items.  Accepts ``["a", "b"]`` and ``[a,b]``.
    """
    s = F.regexp_replace(F.regexp_replace(_c(text), r"^\[", ""), r"\]\z", "")
    trim = lambda x: F.regexp_replace(x, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    items = F.transform(F.split(s, ","), lambda x: F.replace(trim(x), F.lit('"'), F.lit("")))
    return F.filter(items, lambda x: F.length(x) > 0)


def artifact_id(key="key", prefix: str = "") -> Column:
    """Model id of an object key ``<folder>/<name>.<...>.<id>.bin/...``; null otherwise, and for
    keys outside ``prefix``."""
    parts = F.split(_c(key), "/")
    dparts = F.split(F.try_element_at(parts, F.lit(2)), r"\.")
    ok = (F.size(parts) >= 2) & (F.size(dparts) >= 3) & (F.try_element_at(dparts, F.lit(-1)) == ARTIFACT_SUFFIX)
    if prefix:
        ok = ok & F.startswith(_c(key), F.lit(prefix))
    return F.when(ok, F.try_element_at(dparts, F.lit(-2)))


def clean_run_id(run_id) -> Column:
    """Replace ':' and '+' by '_' so the id is safe in object names."""
    return F.translate(_c(run_id), RUN_ID_UNSAFE, RUN_ID_SAFE)


def ms_to_seconds(ms) -> Column:
    """Whole seconds of a millisecond count (integer division, toward zero)."""
    return (_c(ms).cast("long") / F.lit(1000)).cast("long")


def to_epoch_ms(ts) -> Column:
    return F.unix_millis(_c(ts).cast("timestamp"))


def to_bool_text(b) -> Column:
    """Boolean to ``true`` / ``false`` text."""
    return F.lower(_c(b).cast("string"))


def kv_get(entries, key: str) -> Column:
    """Value of the last entry of ``key`` in a key-value list; null without one.  Builds no map."""
    return F.try_element_at(F.filter(_c(entries), lambda x: x["key"] == F.lit(key)), F.lit(-1))["value"]


def display_id(tags_map, run_id="run_id") -> Column:
    """Model version tag if present, else the run id."""
    return F.coalesce(F.try_element_at(_c(tags_map), F.lit("model_version")), _c(run_id))


def short_name(name, fallback_id) -> Column:
    """Given name, else the first characters of the id."""
    return F.coalesce(_c(name), F.substring(_c(fallback_id), 1, SHORT_NAME_LEN))


def default_text(c, default: str = "") -> Column:
    """Null to a default text (used for FlightNum / Carrier)."""
    return F.coalesce(_c(c), F.lit(default))


def kv_last_wins(entries) -> Column:
    """Key-value list to map where a repeated key keeps its last value.

    Entries later in the list shadow earlier ones; no session-wide map-key
    dedup policy is needed because duplicates are removed before building.
    """
    e = _c(entries)
    keys = F.transform(e, lambda x: x["key"])
    kept = F.filter(e, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(e), F.lit(1))), x["key"]))
    return F.map_from_entries(kept)
