"""Quality rules with robust multivariate outliers: minimum covariance determinant (MCD) per
language and source.

Each text gives five transformed statistics: log mean word length, log number of words, and
arcsine square roots of the shares of symbol characters, repeated lines and words in repeated
windows. Texts that fail the base rules are rejected outright. Over the others every (lang,
source) group gets a centre and scatter from its central three quarters: starting at medians and
median deviations, concentration steps re-estimate both from the documents nearest by
Mahalanobis distance until no group's determinant falls. A text farther than ``CUTOFF`` is rejected.

Every step is one aggregate over all statistics by group and distance bin, in whole numbers (so
results do not depend on the order of sums); only bins reach a group's task, whatever the
group's size. Groups under ``SMALL`` documents are estimated together within their language.

Defined cases: a null text has no words and fails the base rules; null lang or source is a group
of its own; rows with equal or null doc_id are judged one by one; a group without enough texts
to estimate keeps what the base rules keep; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.tables import checked_broadcast, keep_rest, materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"

CORE = 0.75
SMALL = 60
# Fixed value: consistency of the scatter of the central 75 % of a 5-variate normal,
# 0.75 / P(chi2 with 7 df <= 0.75 quantile of chi2 with 5 df).
CONSISTENCY = 1.41
# Squared distance beyond which a text is rejected: the 0.99999 quantile of chi2 with 5 df.
CUTOFF = 30.86
# Least standard deviation of each statistic, about what one odd line or word does to a clean text.
LEAST_SD = (0.12, 1.0, 0.05, 0.20, 0.12)
SCALE = 1024
P = len(LEAST_SD)

STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def repeated_words(w: W.Words, k: int = 5) -> np.ndarray:
    """Words of each document inside runs of k words that the document holds twice or more."""
    g, doc = W.ngrams(w.hashes(), k), w.doc
    at = np.flatnonzero(W.inside(doc, k))
    order = at[np.lexsort((g[at], doc[at]))]
    same = (g[order[1:]] == g[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    hit = np.zeros(max(w.n, 1), np.bool_)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return _per_row(W.covered(hit, k, w.n), w.first) if w.n else np.zeros(len(w.first) - 1, np.int64)


_SYMBOL = np.zeros(256, np.bool_)
_SYMBOL[list(SYMBOLS)] = True
_BLANK = b" \t\n\x0b\x0c\r"


def _statistics(batches):
    for b in batches:
        others = [n for n in b.schema.names if n != "__text"]
        for lo, hi, buf, offs in W.slices(b.column("__text")):
            w = W.tokenize(buf, offs, W.SPACE)
            chars = _per_row(((buf & 0xC0) != 0x80) & ~W.SPACE[buf], offs)
            symbols = _per_row(_SYMBOL[buf], offs)
            raw, n_lines, n_dup = buf.tobytes(), [], []
            for a, z in zip(offs[:-1].tolist(), offs[1:].tolist()):
                lines = [x for x in raw[a:z].split(b"\n") if x.strip(_BLANK)]
                n_lines.append(len(lines))
                n_dup.append(len(lines) - len(set(lines)))
            cols = [w.counts, chars, symbols, n_lines, n_dup, repeated_words(w)]
            yield pa.RecordBatch.from_arrays(
                [b.column(n).slice(lo, hi - lo) for n in others] + [pa.array(c, pa.int64()) for c in cols],
                others + [x.split()[0] for x in STATS.split(", ")])


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, and the base statistics. Input columns of their names are replaced."""
    names = [x.split()[0] for x in STATS.split(", ")]
    docs = docs.drop(*[n for n in names if n != text]).withColumnRenamed(text, "__text")
    kept = [f for f in docs.schema.fields if f.name != "__text"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + STATS
    return docs.mapInArrow(_statistics, schema)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _share(part: str, whole: str) -> Column:
    return F.asin(F.sqrt(F.least(F.col(part) / F.greatest(F.col(whole), F.lit(1)), F.lit(1.0))))


def _vector() -> list[Column]:
    """The transformed statistics in whole steps of 1 / SCALE."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    x = [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log(n), _share("n_symbols", "word_chars"),
         _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")]
    return [F.round(v * SCALE).cast("long").alias(f"q{i}") for i, v in enumerate(x)]


GROUP = ["g_lang", "g_source"]
ESTIMATE = "g_lang string, g_source string, mean array<double>, inverse array<double>, logdet double"


def _solved(key, n: float, mean: np.ndarray, scatter: np.ndarray):
    import pandas as pd
    scatter = scatter + np.diag(np.square(LEAST_SD))
    return pd.DataFrame({"g_lang": [key[0]], "g_source": [key[1]], "mean": [mean.tolist()],
                         "inverse": [np.linalg.inv(scatter).ravel().tolist()],
                         "logdet": [float(np.linalg.slogdet(scatter)[1])]})


def _start(key, pdf):
    """Medians and median deviations of each statistic from its histogram."""
    mean, sd = np.zeros(P), np.zeros(P)
    for i, part in pdf.groupby("i"):
        v, n = part["v"].to_numpy(np.float64), part["n"].to_numpy()

        def median(x):
            order = np.argsort(x, kind="stable")
            return x[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]
        mean[i] = median(v)
        sd[i] = 1.4826 * median(np.abs(v - mean[i]))
    return _solved(key, 0, mean / SCALE, np.diag(np.square(sd / SCALE)))


def _concentrate(key, pdf):
    """Centre and scatter of the nearest three quarters, from sums by distance bin."""
    pdf = pdf.sort_values("bin")
    total = pdf["n"].cumsum().to_numpy()
    upto = int(np.searchsorted(total, CORE * total[-1])) + 1
    s = pdf.iloc[:upto].drop(columns=[*GROUP, "bin"]).sum()
    n = float(s["n"])
    mean = np.array([s[f"s{i}"] for i in range(P)], np.float64) / n
    scatter = np.array([[s[f"s{min(i, j)}{max(i, j)}"] for j in range(P)] for i in range(P)], np.float64) / n
    scatter = (scatter - np.outer(mean, mean)) / SCALE**2
    return _solved(key, n, mean / SCALE, CONSISTENCY * scatter)


def _distance() -> Column:
    d = [F.col(f"q{i}") / SCALE - F.col("mean")[i] for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        row = F.lit(0.0)
        for j in range(P):
            row = row + F.col("inverse")[i * P + j] * d[j]
        total = total + d[i] * row
    return total


def _with_estimate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    e = checked_broadcast(estimates.withColumnsRenamed({g: f"e_{g}" for g in GROUP}))
    on = F.lit(True)
    for g in GROUP:
        on = on & F.col(g).eqNullSafe(F.col(f"e_{g}"))
    return rows.join(e, on, "left")


def groups(stats: DataFrame) -> DataFrame:
    """(lang, source) with the group each is estimated in: itself, or its language's small sources."""
    n = stats.groupBy("lang", "source").agg(F.sum((~base_failed()).cast("long")).alias("n"))
    small = F.col("n") < SMALL
    return n.select(F.col("lang").alias("k_lang"), F.col("source").alias("k_source"),
                    F.col("lang").cast("string").alias("g_lang"),
                    F.when(small, F.lit("small")).otherwise(F.concat(F.lit("="), F.col("source").cast("string"))).alias("g_source"))


def _grouped(stats: DataFrame, by: DataFrame) -> DataFrame:
    return stats.join(checked_broadcast(by), F.col("lang").eqNullSafe(F.col("k_lang"))
                      & F.col("source").eqNullSafe(F.col("k_source")), "left").drop("k_lang", "k_source")


def estimate(stats: DataFrame, by: DataFrame) -> DataFrame:
    """MCD centre and inverse scatter of every group."""
    rows = materialize(_grouped(stats.filter(~base_failed()), by).select(*GROUP, *_vector()), "vectors")
    long = rows.select(*GROUP, F.posexplode(F.array(*[f"q{i}" for i in range(P)])).alias("i", "v"))
    hist = long.groupBy(*GROUP, "i", F.shiftleft(F.shiftright("v", 3), 3).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    now = materialize(hist.groupBy(*GROUP).applyInPandas(_start, ESTIMATE), "start")
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(f"q{i}").alias(f"s{i}") for i in range(P)],
            *[F.sum(F.col(f"q{i}") * F.col(f"q{j}")).alias(f"s{i}{j}") for i, j in pairs]]
    step = 0
    while True:
        binned = _with_estimate(rows, now).withColumn("bin", F.floor(F.log1p(_distance()) * 32))
        new = materialize(binned.groupBy(*GROUP, "bin").agg(*sums).groupBy(*GROUP)
                          .applyInPandas(_concentrate, ESTIMATE), f"step{step}")
        if step:  # a group keeps its estimate once its determinant no longer falls
            old = now.select(*[F.col(g).alias(f"e_{g}") for g in GROUP], F.col("logdet").alias("before"),
                             F.struct("mean", "inverse", "logdet").alias("old"))
            on = F.col("g_lang").eqNullSafe(F.col("e_g_lang")) & F.col("g_source").eqNullSafe(F.col("e_g_source"))
            fell = F.col("before") - F.col("logdet") >= 1e-3
            new = materialize(new.join(old, on).select(*GROUP, fell.alias("fell"), F.when(
                fell, F.struct("mean", "inverse", "logdet")).otherwise(F.col("old")).alias("e")), f"kept{step}")
            more, new = not new.filter("fell").isEmpty(), new.select(*GROUP, "e.*")
            if not more:
                return new
        now, step = new, step + 1


def verdicts(stats: DataFrame, by: DataFrame, estimates: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with base_failed, distance (null without an estimate) and kept."""
    extra = [c for c in stats.columns]
    rows = _with_estimate(_grouped(stats, by).select(*extra, *GROUP, *_vector()), estimates)
    return (rows.withColumn("base_failed", base_failed()).withColumn("distance", _distance())
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))
            .select(*extra, "base_failed", "distance", "kept"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, distance and kept for every row."""
    stats = materialize(statistics(docs.select("doc_id", "lang", "source", "text")), "statistics")
    by = materialize(groups(stats), "groups")
    return verdicts(stats, by, estimate(stats, by)).drop("lang", "source")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept; texts are read a second time instead of being shuffled."""
    used = ["lang", "source", "text"]
    stats = materialize(statistics(docs.select(*used)), "statistics")
    by = materialize(groups(stats), "groups")
    estimates = estimate(stats, by)
    packed = keep_rest(docs, used).withColumn("__body", F.col("text"))
    kept = verdicts(statistics(packed), by, estimates).filter("kept")
    return kept.select(*[F.col("__body").alias("text") if c == "text" else F.col(f"`{c}`") if c in used
                         else F.col(f"__rest.`{c}`") for c in docs.columns])
