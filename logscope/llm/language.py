"""Language identification by Bayesian evidence fusion (operator 3).

The posterior of a row's language multiplies

* the likelihood of its text: hashed byte trigrams of the lower-cased letters under each
  language's counts (trigrams overlap, so their log-likelihood is scaled as that of at most ``EFFECTIVE``
  independent ones);
* the likelihood of the declared language (markup ``lang`` or a metadata column) and of the
  address suffix, from counts by the language that the text alone suggests;
* a prior by host, smoothed hierarchically: host, then registered domain (last two labels), then
  all rows, each level adding ``KAPPA`` rows' worth of the level above; the row's own vote is
  taken out of the counts, so its text isn't used twice.

All counts are grouped aggregations over every row.  Trigram counts are summed per task before
they are shuffled, at most ``HELD`` languages at a time, so each task sends about ``BUCKETS`` rows a language.
Only the trigram table (128 KB a language) and the counts by (language, declared language) are broadcast
or held by the driver; host and suffix counts stay tables and are joined.  The hypothesis ``und`` (a uniform text) competes, so that text in
no known language is rejected rather than forced.

Languages: those of the training column with at least ``MIN_ROWS`` rows of text, however many rows the others
have; in a table so small that ``MIN_SHARE`` of its rows is less than that, those with this share.  A text in none of them
cannot be judged by trigrams; if it declares another language, it keeps that one, with the posterior of being none of the known ones.

Defined cases: null or letterless text is ``und``, posterior 1, rejected; null or unknown declarations, hosts and
suffixes give no evidence; ties go to the alphabetically first language; repeated rows are
judged alike; without training rows every row is ``und``.  Input columns are kept; result
columns of the same name are replaced.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import cut, each_raw, fresh

BUCKETS = 1 << 15
EFFECTIVE = 60
KAPPA = 5.0
MIN_SHARE = 0.005
MIN_ROWS = 10
HELD = 256
MIN_POSTERIOR = 0.5
UND = "und"
UND_PRIOR = 0.01
SLICE = 1 << 20

_OTHER = (string.punctuation + string.digits).encode()
_TABLE = bytes(32 if bytes([b]) in [bytes([x]) for x in _OTHER] else b + 32 if 65 <= b <= 90 else b for b in range(256))


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of the byte trigrams of a text, in slices; none if it has no letters."""
    t = b" ".join(text.translate(_TABLE).split())
    if not t:
        return
    t = b" " + t + b" "
    for a in range(0, len(t) - 2, SLICE):
        b = np.frombuffer(t[a:a + SLICE + 2], np.uint8).astype(np.uint32)
        yield (((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(17)


@dataclass
class TextModel:
    """Languages in order and the log-probability of each bucket (last column: uniform)."""

    languages: list[str]
    table: np.ndarray = field(repr=False)

    @property
    def names(self) -> list[str]:
        return [*self.languages, UND]


def train_text(docs: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE,
               min_rows: int = MIN_ROWS) -> TextModel:
    """Trigram counts by language over all rows of ``docs`` whose language has rows enough."""
    rows = docs.select(F.lower(F.col(lang)).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND lang != 'und'")
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = shares.agg(F.sum("n")).first()[0] or 0
    languages = sorted(r["lang"] for r in shares.filter(F.col("n") >= min(min_rows, min_share * total)).collect()) if total else []
    at = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for i, n in sums.items():
                k = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i, np.int32)), pa.array(k.astype(np.int32)), pa.array(n[k])],
                                                 names=["lang", "bucket", "n"])
            sums.clear()

        for b in batches:
            for x, t in zip(b.column(0).to_pylist(), each_raw(b.column(1))):
                for g in trigrams(t):
                    if at[x] not in sums:
                        if len(sums) == HELD:
                            yield from sent()
                        sums[at[x]] = np.zeros(BUCKETS, np.int64)
                    sums[at[x]] += np.bincount(g, minlength=BUCKETS)
        yield from sent()

    table = np.full((BUCKETS, len(languages) + 1), -math.log(BUCKETS), np.float32)
    if languages:
        per_task = rows.filter(F.col("lang").isin(languages)).mapInArrow(count, "lang int, bucket int, n long")
        summed = per_task.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        if len(languages) > HELD:
            summed = cut(summed)
        for a in range(0, len(languages), HELD):        # at most BUCKETS x HELD rows at a time
            counts = np.zeros((BUCKETS, min(HELD, len(languages) - a)))
            got = summed.filter(F.col("lang").between(a, a + HELD - 1)).toPandas()
            counts[got["bucket"], got["lang"] - a] = got["n"]
            counts += 0.5
            table[:, a:a + counts.shape[1]] = np.log(counts / counts.sum(axis=0, keepdims=True))
    return TextModel(languages, table)


def text_evidence(text: str | Column, model: TextModel) -> Column:
    """Array of the scaled log-likelihood per name of the model; null where there are no letters."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(model.table)

    @arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        step = max(1, 4 * SLICE // table.shape[1])
        for arr in batches:
            out = []
            for t in each_raw(arr):
                n, s = 0, np.zeros(table.shape[1])
                for g in trigrams(t):
                    n += len(g)
                    for a in range(0, len(g), step):
                        s += table[g[a:a + step]].sum(axis=0, dtype=np.float64)
                out.append((s * (min(1.0, EFFECTIVE / n))).tolist() if n else None)
            yield pa.array(out, pa.list_(pa.float64()))

    return run(text)


def _dense(index: pa.Array, n: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of (index, n) as rows of a matrix, and which of them are not null."""
    size = index.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    out = np.zeros((len(index), width))
    out[np.repeat(np.arange(len(index)), size), index.flatten().to_numpy(zero_copy_only=False)] = n.flatten().to_numpy(zero_copy_only=False)
    return out, index.is_valid().to_numpy(zero_copy_only=False)[:, None]


def _posterior(prior: np.ndarray, declared: np.ndarray) -> Callable[..., Column]:
    """Columns of evidence -> [number of the likeliest name, its posterior], null without letters.
    ``declared`` has the log-likelihoods of each declared language, the last row being none."""
    width = len(prior)

    def part(ll, vote, decl, *counts) -> list[list[float] | None]:
        has = ll.is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(has)
        out: list[list[float] | None] = [None] * len(has)
        if len(rows):
            ll, vote, decl, *counts = (x.filter(pa.array(has)) for x in (ll, vote, decl, *counts))
            own = np.zeros((len(rows), width))
            own[np.arange(len(rows)), vote.to_numpy(zero_copy_only=False)] = 1      # a row's own vote is not evidence
            p = np.broadcast_to(prior, own.shape)
            for at in (2, 0):       # domain, host; a level without a value hands on the level above
                n, given = _dense(counts[at], counts[at + 1], width)
                p = np.where(given, (n - own + KAPPA * p) / (np.maximum(n.sum(axis=1, keepdims=True) - 1, 0) + KAPPA), p)
            n, given = _dense(counts[4], counts[5], width)
            # P(suffix | language) up to the factor P(suffix), which all languages share
            ratio = np.where(given, (n - own + KAPPA * prior) / (np.maximum(n.sum(axis=1, keepdims=True) - 1, 0) + KAPPA) / prior, 1.0)
            lp = (ll.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) + np.log(np.maximum(p, 1e-300))
                  + declared[decl.fill_null(len(declared) - 1).to_numpy(zero_copy_only=False)] + np.log(np.maximum(ratio, 1e-300)))
            pick = lp.argmax(axis=1)
            post = 1.0 / np.exp(lp - lp.max(axis=1, keepdims=True)).sum(axis=1)
            for i, x, y in zip(rows.tolist(), pick.tolist(), post.tolist()):
                out[i] = [float(x), y]
        return out

    @arrow_udf("array<double>")
    def run(ll: pa.Array, vote: pa.Array, decl: pa.Array, hv: pa.Array, hn: pa.Array, dv: pa.Array, dn: pa.Array,
            sv: pa.Array, sn: pa.Array) -> pa.Array:
        step = max(1, SLICE // width)
        args, out = (ll, vote, decl, hv, hn, dv, dn, sv, sn), []
        for a in range(0, len(ll), step):
            out += part(*(x.slice(a, step) for x in args))
        return pa.array(out, pa.list_(pa.float64()))

    return run


def identify(rows: DataFrame, model: TextModel, text: str = "text", declared: str | None = None,
             host: str | None = None, suffix: str | None = None) -> DataFrame:
    """``rows`` with ``language``, ``posterior``, ``accepted``.

    ``declared``, ``host`` and ``suffix`` name columns of evidence, or are None."""
    names, langs = model.names, model.languages
    replaced = rows.drop("language", "posterior", "accepted")
    ll, vote, decl, oth, hst, dom, suf, res = fresh(replaced, *(f"_{x}" for x in "ll vote decl oth hst dom suf res".split()))
    col = lambda c: F.lower(F.trim(F.col(c))) if c else F.lit(None).cast("string")
    if not langs:
        return replaced.withColumns({"language": F.lit(UND), "posterior": F.lit(1.0), "accepted": F.lit(False)})
    number = F.array_position(F.array(*map(F.lit, langs)), F.col(decl)).cast("int") - 1
    base = (replaced.withColumn(ll, text_evidence(text, model))
            .withColumns({decl: F.regexp_extract(col(declared), "^([a-z]+)", 1), hst: col(host), suf: col(suffix)})
            .withColumns({dom: F.regexp_extract(F.col(hst), r"([^.]+\.[^.]+)$", 1),
                          vote: F.array_position(F.col(ll), F.array_max(F.col(ll))).cast("int") - 1}))
    base = base.withColumns({dom: F.when(F.col(dom) != "", F.col(dom)), decl: F.when(F.col(decl).isin(langs), number),
                             oth: F.when((F.col(decl) != "") & (F.col(decl) != UND) & ~F.col(decl).isin(langs), F.col(decl))})

    narrow = cut(base.select(vote, decl, hst, dom, suf).filter(F.col(vote).isNotNull())
                 .groupBy(vote, decl, hst, dom, suf).agg(F.count(F.lit(1)).alias("n")))

    def summed(by: str, key: str, counts: str) -> DataFrame:
        """The votes of each value, as a list no longer than the names."""
        each = narrow.filter(F.col(by).isNotNull()).groupBy(F.col(by).alias(key), F.col(vote).alias("vote")).agg(F.sum("n").alias("n"))
        return cut(each.groupBy(key).agg(F.collect_list(F.struct("vote", "n")).alias(counts)))

    # bounded: names x (languages + null)
    table = {(r[vote], r[decl]): r["n"] for r in narrow.groupBy(vote, decl).agg(F.sum("n").alias("n")).collect()}
    votes = np.zeros((len(names), len(langs) + 1))
    for (v, d), n in table.items():
        votes[v, len(langs) if d is None else d] = n
    prior = (votes.sum(axis=1) + 1.0) / (votes.sum() + len(names))
    prior[-1] = UND_PRIOR
    prior /= prior.sum()
    given = np.zeros((len(langs) + 1, len(names)))
    if declared:
        known = votes[:, :-1]
        given[:-1] = np.log((known + 1.0) / (known.sum(axis=1, keepdims=True) + len(langs))).T
        given[:-1, -1] = -math.log(len(langs))

    out, evidence = base, []
    for by, on in ((hst, host), (dom, host), (suf, suffix)):
        if on:
            key, counts = fresh(out, f"{by}_", f"{by}_c")
            out = out.join(summed(by, key, counts), F.col(by) == F.col(key), "left")
            evidence += [F.col(counts)["vote"], F.col(counts)["n"]]
        else:
            evidence += [F.lit(None).cast("array<int>"), F.lit(None).cast("array<long>")]
    out = out.withColumn(res, _posterior(prior, given)(F.col(ll), F.col(vote), F.col(decl), *evidence))
    known = F.element_at(F.array(*map(F.lit, names)), F.element_at(F.col(res), 1).cast("int") + 1)
    known = F.coalesce(known, F.lit(UND))
    pick = F.when((known == UND) & F.col(ll).isNotNull(), F.coalesce(F.col(oth), known)).otherwise(known)
    post = F.coalesce(F.element_at(F.col(res), 2), F.lit(1.0))
    return out.select(*[F.col(f"`{c}`") for c in replaced.columns], pick.alias("language"), post.alias("posterior"),
                      ((pick != UND) & (post >= MIN_POSTERIOR)).alias("accepted"))


def page_evidence(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, text, declared, host, suffix) of raw web pages."""
    h, u = F.col(html), F.col(url)
    tag = F.regexp_extract(h, r"(?i)<html\b[^>]*?(?<![\w:-])lang\s*=\s*[\"']?([A-Za-z]+)", 1)
    name = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    text = F.regexp_replace(h, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    blank = lambda c: F.when(c != "", c)
    return pages.select(F.col(page_id).alias("page_id"), text.alias("text"), blank(tag).alias("declared"),
                        blank(name).alias("host"), blank(F.regexp_extract(name, r"\.([a-z]+)$", 1)).alias("suffix"))
