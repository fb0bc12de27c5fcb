"""Column builders: every extractor is a built-in Spark expression (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logscope.functions import patterns as P


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- levels (L1)
def level(line="line", mode: str = "word") -> Column:
    """First log level of a line, ``''`` when none (NULL on NULL).

    ``word`` (L1a): any case, whole word, upper-cased (the implemented job form).
    ``plain`` (L1b): case-sensitive, anywhere in the line (the documented form).
    """
    if mode == "word":
        return F.upper(F.regexp_extract(_c(line), P.LEVEL_WORD, 1))
    if mode == "plain":
        return F.regexp_extract(_c(line), P.LEVEL_PLAIN, 1)
    raise ValueError(f"unknown level mode {mode!r}")


def level_matches(line="line") -> Column:
    """Every case-sensitive level occurrence in a line, in order."""
    return F.regexp_extract_all(_c(line), F.lit(P.LEVEL_PLAIN), 1)


# ---------------------------------------------------------------- ids from path (L2)
def plain_path(path="path") -> Column:
    """A file path without scheme and authority and with ``%20`` style escapes undone, so that
    the paths of different sources compare."""
    return F.url_decode(F.replace(F.regexp_replace(_c(path), r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", ""),
                                  F.lit("+"), F.lit("%2B")))


def application_id(path="path") -> Column:
    return F.regexp_extract(_c(path), P.APPLICATION_ID, 1)


def cluster_id(app_id="application_id") -> Column:
    return F.regexp_extract(_c(app_id), P.CLUSTER_ID, 1)


def app_number(app_id="application_id") -> Column:
    return F.regexp_extract(_c(app_id), P.APP_NUMBER, 1)


def container_id(path="path") -> Column:
    return F.regexp_extract(_c(path), P.CONTAINER_ID, 1)


def container_attempt(container="container_id") -> Column:
    return F.regexp_extract(_c(container), P.CONTAINER_PARTS, 1)


def container_number(container="container_id") -> Column:
    return F.regexp_extract(_c(container), P.CONTAINER_PARTS, 2)


def container_role(number="container_no") -> Column:
    c = _c(number)
    return (F.when(c == "", F.lit(""))
            .when(c == P.AM_CONTAINER_NO, F.lit("ApplicationMaster"))
            .otherwise(F.lit("Executor")))


def path_ids(path="path") -> dict[str, Column]:
    """All identity columns of a container log path, as a ``withColumns`` map."""
    app = application_id(path)
    cont = container_id(path)
    return {
        "application_id": app,
        "cluster_id": cluster_id(app),
        "app_number": app_number(app),
        "container_id": cont,
        "attempt": container_attempt(cont),
        "container_no": container_number(cont),
    }


def cluster_start(cluster="cluster_id") -> Column:
    """Cluster id is the ResourceManager start in epoch milliseconds; as a UTC
    wall-clock TIMESTAMP_NTZ (zone-free arithmetic, whatever the session zone)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", _c(cluster).try_cast("bigint"), epoch)


# ---------------------------------------------------------------- time (L3)
def _parse_time_text(s: Column) -> Column:
    """Parse text produced by ``TS_ANY`` or ``TS_ANCHORED`` as TIMESTAMP_NTZ.

    The digits are rearranged into ISO text (the third character tells the two
    layouts apart) and cast, so no session zone takes part: a time that a
    daylight-saving change skips stays as written.  An invalid time is NULL.
    """
    iso = F.translate(s, "/,", "-.")
    return F.when(F.substring(s, 3, 1) == "/", F.concat(F.lit("20"), iso)).otherwise(iso).try_cast("timestamp_ntz")


def log_time(line="line", mode: str = "lenient") -> Column:
    """Timestamp of a log line as TIMESTAMP_NTZ; NULL when absent or invalid.

    ``lenient`` (L3a): first yy/MM/dd or yyyy-MM-dd time anywhere in the line,
    with optional ``,SSS`` (the implemented job form).
    ``anchored`` (L3b): ``yy/MM/dd HH:mm:ss`` at the start of the line (documented form).
    ``try_cast`` keeps ANSI mode on (H5): a bad time is NULL, never a failed job.
    Inside one expression the extracted text may be evaluated twice; use
    ``with_log_time`` on a frame to extract once per line.
    """
    if mode == "lenient":
        return _parse_time_text(F.regexp_extract(_c(line), P.TS_ANY, 1))
    if mode == "anchored":
        return _parse_time_text(F.regexp_extract(_c(line), P.TS_ANCHORED, 1))
    raise ValueError(f"unknown time mode {mode!r}")


def with_log_time(df, line: str = "line", name: str = "ts", mode: str = "lenient"):
    """``df`` plus the parsed time column ``name``, extracting the text once per line.

    The extracted text is its own projection; Catalyst keeps it separate
    because the parse reads it more than once, so the regex runs once.
    """
    if mode not in ("lenient", "anchored"):
        raise ValueError(f"unknown time mode {mode!r}")
    tmp = f"__{name}_text"
    pattern = P.TS_ANY if mode == "lenient" else P.TS_ANCHORED
    df = df.withColumn(tmp, F.regexp_extract(F.col(line), pattern, 1))
    return df.withColumn(name, _parse_time_text(F.col(tmp))).drop(tmp)


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds (double, microsecond exact)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def minutes_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(6e7)


# ---------------------------------------------------------------- record (L4)
def component(line="line") -> Column:
    return F.regexp_extract(_c(line), P.COMPONENT, 2)


def is_entry_header(line="line") -> Column:
    return _c(line).rlike(P.ENTRY_HEADER)


def masked_tokens(line="line") -> Column:
    """The words of a line with paths, hexadecimal numbers and numbers masked: lines of one message share them."""
    text = _c(line)
    for pattern, mask in P.SHAPE_MASKS:
        text = F.regexp_replace(text, pattern, mask)
    return F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+")


# ---------------------------------------------------------------- units
def size_bytes(value: Column, unit: Column) -> Column:
    """``value`` (decimal text) times the binary multiple named by ``unit``."""
    mult = F.when(unit == "B", F.lit(1.0))
    for name, exp in P.UNIT_EXPONENT.items():
        if exp:
            mult = mult.when(unit == name, F.lit(float(1024 ** exp)))
    return value.try_cast("double") * mult          # "1.2.3" in a corrupt line → NULL, not a failed job


def marked_groups(line: Column, pattern: str, groups: int) -> Column:
    """The first match's groups, each after a ``\\u0001``, or the line itself when the
    pattern does not occur: one evaluation of the pattern for all groups."""
    return F.regexp_replace(line, f"(?s)^.*?(?:{pattern}).*$", "".join(f"\u0001${i + 1}" for i in range(groups)))


def typed_groups(g: Column, groups: dict[str, tuple[int, str]]) -> dict[str, Column]:
    """``{name: group idx of the array g cast to type}``; '' → NULL before casts (as ``extract``)."""
    out = {}
    for name, (idx, typ) in groups.items():
        v = F.element_at(g, idx)
        out[name] = v if typ == "string" else F.nullif(v, F.lit("")).try_cast(typ)
    return out


def extract(line: Column, pattern: str, groups: dict[str, tuple[int, str]]) -> dict[str, Column]:
    """``{name: regexp_extract(line, pattern, idx) cast to type}``; '' → NULL before casts.

    ``try_cast``: a value that does not fit (a 25-digit count in a corrupt
    line) becomes NULL instead of failing the whole job under ANSI mode.
    """
    out = {}
    for name, (idx, typ) in groups.items():
        g = F.regexp_extract(line, pattern, idx)
        out[name] = g if typ == "string" else F.nullif(g, F.lit("")).try_cast(typ)
    return out
