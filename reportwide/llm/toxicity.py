"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length.

Folding makes spellings meet: accents go, look-alike letters of other scripts, wide and styled
letters become Latin ones, digits and signs inside words become the letters they stand for (``1``,
``!`` and ``l`` all become ``i``, as ``1`` stands for both; a number stays a number), invisible
characters go, and all else between words becomes one space. Lexicon, exceptions and texts are
folded alike. One automaton holds the terms and the exception phrases; a term found inside an
exception phrase does not count.

A term is a word or, with a star, the beginning of words. The listed ones have a severity; the
labelled texts add beginnings of their own that pass a likelihood ratio test (words of toxic texts in
languages that the list does not know). A term's weight is the log of its mean density in toxic texts
over that in other ones, smoothed; of several terms at one word the heaviest counts. In these counts
texts with one sketch (the smallest hash of their word pairs) count once, so that groups of copies and
near copies do not make a word look toxic. The score is a logistic curve over the log of the weight per
hundred words; it is fitted on levels that each half of the texts gets from the terms of the other half.

The model is fitted on at most ``SAMPLE`` labelled doc_ids, those with the smallest hash, and on at
most twice as many rows. Scoring is one narrow pass over all whole texts.

Defined cases: a null or empty text has no terms and gets the score of weight 0; labels with a null
doc_id or toxic are not used, conflicting ones are averaged (0.5 or more: 1); rows with equal or null
doc_id are scored one by one (null ids are not held out); without labels of both classes the
severities and a fixed curve are used.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.tables import materialize

SAMPLE = 12_000
EXTRA_TERMS = 2000  # most terms the labelled texts add
STEM = (4, 12)  # shortest and longest beginning
THRESHOLD = 0.3
LEAST_TEXTS = 5
LEAST_RATIO = 24.0  # likelihood ratio statistic of an added term
LEAST_ODDS = 4.0
RARE = 1e-5  # density of a term that no text has
HELD = 300_000  # terms a task holds before it passes their counts on
EXTRA_WORDS = 20  # added to a text's length, so that very short texts do not stand on one word
FIXED_CURVE = (2.0, -3.0)

# Severity: how many times likelier a text with the term is toxic when no label speaks for or against it.
LEXICON = {
    2: """airhead arrogant awful blockhead bonehead boring brainless buffoon clueless clumsy crap crappy crazy creep
          creepy crook dimwit dope dork dreadful fatso fake freak geek goof gross hopeless horrible ignorant lame lazy
          lunatic nerd nuts pest phony puke rotten sick silly slob snob spineless sucks terrible ugly weirdo whiny wimp
          lächerlich dumm peinlich nul nulle bête moche tonto tonta feo fea""",
    4: """ass bastard bimbo bully clown coward cretin despicable dirtbag disgrace disgraceful disgusting dumb dumbass
          dummy dunce fool foolish garbage halfwit idiot idiotic imbecile jackass jerk liar loser maggot miserable moron
          moronic nitwit numbskull parasite pathetic pig pinhead repulsive revolting sewage sleazy slimeball slut
          stupid tramp trash trashy twit useless vermin vile waste wretch worthless
          abschaum blödmann depp dreck dummkopf trottel versager widerlich wertlos erbärmlich vollidiot
          abruti connard crétin débile imbécile minable ordure pathétique salaud
          asqueroso basura cretino estúpido estúpida idiota imbécil inútil payaso patético perdedor""",
    8: """asshole arsehole bitch bullshit cunt dickhead douchebag fuck fucker fucking motherfucker prick pussy retard
          retarded scum scumbag shit shithead shitty subhuman twat wanker whore arschloch hurensohn scheisse wichser
          enculé salope putain cabrón mierda pendejo puta""",
}
EXCEPTIONS = """trash can, trash cans, trash bin, trash bag, trash bags, trash collection, trash compactor, waste of time,
    waste water, waste management, garbage can, garbage truck, garbage collection, garbage collector, clown fish,
    circus clown, class clown, pond scum, soap scum, idiot proof, sore loser, winner or loser, pussy willow, guinea pig,
    pig iron, silly putty, crazy quilt, dope sheet, gross domestic product, gross income, gross margin, gross weight,
    fake leather, sick leave, sick day, rotten apple, wild ass, fool proof, april fool, april fools, prick of a needle,
    nuts and bolts, mixed nuts, crash test dummy, ventriloquist dummy, the tramp, maggot therapy, not stupid, not an idiot,
    not worthless, not useless, not pathetic"""

# Letters of other scripts that look like Latin ones: each pair is the letter and the Latin one.
HOMOGLYPHS = """аa вb еe ёe зz іi їi јj кk мm нh оo рp сc тt уy ўy хx ьb ԁd ԛq ԝw ѕs һh ӏl ґr пn
    αa βb εe ηn ιi κk νv οo ρp τt υu χx ωw γy
    ßs øo łl đd ðd ħh ŧt ıi ſs ɑa ɡg ɩi ʏy ʀr"""
# Digits and signs that stand for letters; l joins i.
DIGITS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i"}
INVISIBLE = "­​‌‍⁠﻿"
# One or two signs directly before a letter or digit belong to a word; any more are decoration.
_SIGN = re.compile(r"(?<![@$!])[@$!]{1,2}(?=[^\W_])")
_HAS_SIGN = re.compile(r"[@$!]")
# A number is no word, whatever its digits could stand for.
_NUMBER = re.compile(r"(?<![^\W_])[0-9]+(?![^\W_])")
_HAS_DIGIT = re.compile(r"[0-9]")


def _base(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c).lower() if not unicodedata.combining(x))


def _table() -> dict[int, str]:
    out = {}
    styled = [(0x00, 0x250), (0x370, 0x530), (0x1E00, 0x1F00), (0x2100, 0x2150), (0x2460, 0x2500), (0xFF00, 0xFF60),
              (0x1D400, 0x1D800)]
    alike = {pair[0]: pair[1] for pair in HOMOGLYPHS.split()}
    for lo, hi in styled:
        for code in range(lo, hi):
            c = "".join(alike.get(x, x) for x in _base(chr(code)))
            c = "".join(alike.get(x, x) for x in c)
            c = "".join(DIGITS.get(x, x) for x in c).replace("l", "i")
            out[code] = "".join(x if x.isalnum() else " " for x in c) or " "
    for code in [*map(ord, INVISIBLE), *range(0x300, 0x370)]:
        out[code] = ""
    for code in [*range(0x2010, 0x2060), *range(0x3000, 0x3004)]:
        out.setdefault(code, " ")
    return out


class _Fold(dict):
    """Code points outside the table are kept if they are letters or digits, else they become a space."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        out = self[code] = c if c.isalnum() else " "
        return out


_TABLE = _Fold(_table())
_SIGN_LETTERS = str.maketrans(SIGNS)


def fold(text: str) -> str:
    """Folded words, a space before, between and after them."""
    if _HAS_DIGIT.search(text):
        text = _NUMBER.sub("0", text)
    if _HAS_SIGN.search(text):
        text = _SIGN.sub(lambda m: m.group().translate(_SIGN_LETTERS), text)
    return f" {' '.join(text.translate(_TABLE).split())} "


def lexicon() -> dict[str, float]:
    """Severity of every folded term, plurals included."""
    out: dict[str, float] = {}
    for severity, words in LEXICON.items():
        for w in words.split():
            for form in (w, w + "s"):
                out.setdefault(fold(form).strip(), float(severity))
    return out


def exceptions() -> list[str]:
    return sorted({fold(p).strip() for p in EXCEPTIONS.split(",")})


class Model:
    """Weights of the folded terms, and the curve; the automaton is built where it is used."""

    def __init__(self, weights: dict[str, float], slope: float = FIXED_CURVE[0], shift: float = FIXED_CURVE[1]):
        self.weights, self.slope, self.shift, self._automaton = weights, slope, shift, None

    def __getstate__(self):
        return {**vars(self), "_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick
            a = ahocorasick.Automaton()
            for term, w in self.weights.items():
                term = f" {term[:-1]}" if term.endswith("*") else f" {term} "
                a.add_word(term, (len(term), w))
            for phrase in exceptions():
                a.add_word(f" {phrase} ", (len(phrase) + 2, None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def found(self, folded: str) -> tuple[float, int]:
        """Weight and number of the words of a folded text that a term matches outside exception phrases."""
        terms: dict[int, float] = {}
        spared = []
        for end, (size, w) in self.automaton.iter(folded):
            start = end - size + 1
            if w is None:
                spared.append((start, end))
            elif w > terms.get(start, 0.0):
                terms[start] = w
        total, n, k, reach = 0.0, 0, 0, -1
        spared.sort()
        for start in sorted(terms):
            while k < len(spared) and spared[k][0] <= start:
                reach = max(reach, spared[k][1])
                k += 1
            if reach <= start:  # the word begins after every exception that began before it
                total += terms[start]
                n += 1
        return total, n

    def level(self, text: str | None) -> tuple[float, int]:
        """Log of the weight per hundred words, and the number of terms."""
        folded = fold(text or "")
        total, n = self.found(folded)
        return float(np.log1p(100 * total / (folded.count(" ") - 1 + EXTRA_WORDS))), n

    def scores(self, level: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * level + self.shift, -500, 500)))


def held_out() -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sketch(words: list[str]) -> int:
    """Smallest hash of neighbouring words: texts share it with the probability of their Jaccard similarity."""
    pairs = {zlib.crc32(f"{a} {z}".encode()) for a, z in zip(["", *words], words)}
    return int(W.mix(np.fromiter(pairs, np.uint64, len(pairs))).min() >> np.uint64(1)) if pairs else 0


def _sketches(batches):
    for b in batches:
        kinds = [sketch(fold(t or "").split()) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("y"), b.column("rid"), b.column("text"), pa.array(kinds, pa.int64())],
                                         ["y", "rid", "text", "kind"])


def beginnings(words: Counter, known: dict[str, float]) -> dict[str, int]:
    """How often words begin with each stem (marked by a star), and how often each whole word comes.

    A known word counts for itself alone, so that what it begins with does not look toxic.
    """
    out: Counter = Counter()
    for w, n in words.items():
        out[w] += n
        if w in known:
            continue
        for k in range(STEM[0], min(STEM[1], len(w)) + 1):
            out[w[:k] + "*"] += n
    return out


_TERMS = "term string, half int, a long, b long, da double, db double"


def _terms(batches):
    """Texts that hold a term and the sum of its densities in them, toxic (a) and other (b), by half."""
    def flush():
        keys, values = list(held), np.array(list(held.values())).reshape(-1, 4)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in keys], pa.string()), pa.array([h for _, h in keys], pa.int32()),
             *(pa.array(values[:, i].astype(np.int64)) for i in (0, 1)), *(pa.array(values[:, i]) for i in (2, 3))],
            ["term", "half", "a", "b", "da", "db"])
    held: dict[tuple[str, int], list[float]] = {}
    known = lexicon()
    for b in batches:
        for y, rid, text in zip(b.column("y").to_pylist(), b.column("rid").to_pylist(), b.column("text").to_pylist()):
            w = Counter(fold(text or "").split())
            size, half = max(1, w.total()), rid & 1
            for t, n in [("", 0), *beginnings(w, known).items()]:  # the empty term stands for the text itself
                v = held.setdefault((t, half), [0.0] * 4)
                v[1 - y] += 1
                v[3 - y] += n / size
            if len(held) > HELD:
                yield flush()
    yield flush()


def ratio(a: Column, b: Column, n1: float, n0: float) -> Column:
    """Likelihood ratio statistic of a term in a of n1 toxic and b of n0 other texts."""
    def part(x, n, p):
        log = lambda q: F.log(F.greatest(q, F.lit(1e-300)))
        return x * log(p) + (n - x) * log(1 - p)
    p, n1, n0 = (a + b) / (n1 + n0), F.lit(float(n1)), F.lit(float(n0))
    return 2 * (part(a, n1, a / n1) + part(b, n0, b / n0) - part(a, n1, p) - part(b, n0, p))


def _weights(terms: DataFrame, halves: tuple[int, ...]) -> dict[str, float] | None:
    """Weights of listed and added terms from the texts of the given halves; None without both classes."""
    here = F.col("half").isin(*halves)
    sums = terms.filter(here).groupBy("term").agg(*(F.sum(c).alias(c) for c in ("a", "b", "da", "db")))
    size = sums.filter("term = ''").first()
    if not size or not size["a"] or not size["b"]:
        return None
    a, b, n1, n0 = F.col("a"), F.col("b"), size["a"], size["b"]
    known = lexicon()
    mine = terms.sparkSession.createDataFrame([(t,) for t in known], "term string")
    gain = ratio(a, b, n1, n0)
    extra = (sums.filter((F.col("term") != "") & (a >= LEAST_TEXTS) & (gain >= LEAST_RATIO)
                         & ((a + 0.5) / (n1 + 1) >= LEAST_ODDS * (b + 0.5) / (n0 + 1)))
             .join(F.broadcast(mine), "term", "left_anti").orderBy(gain.desc(), "term").limit(EXTRA_TERMS))
    out = {}
    for r in sums.join(F.broadcast(mine), "term").union(extra).collect():
        severity = known.pop(r["term"], 1.0)
        w = np.log((r["da"] / n1 + severity * RARE) / (r["db"] / n0 + RARE))
        if w > 0:
            out[r["term"]] = float(w)
    return {**out, **{t: float(np.log(s)) for t, s in known.items()}}


def curve(level: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with a small ridge."""
    a, c = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * level + c, -500, 500)))
        g = np.array([((p - y) * level).sum() + 1e-2 * a, (p - y).sum()])
        q = p * (1 - p) + 1e-9
        h = np.array([[(q * level * level).sum() + 1e-2, (q * level).sum()], [(q * level).sum(), q.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(c)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled doc_ids that are not held out."""
    spark = docs.sparkSession
    known = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
             .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
            .select("y", F.xxhash64("doc_id", "text").alias("rid"), "text"))
    rows = materialize(rows.mapInArrow(_sketches, "y int, rid long, text string, kind long"), "labelled")
    one = rows.groupBy("y", "kind").agg(F.min("rid").alias("rid")).select("rid").distinct()
    rows = materialize(rows.join(one, "rid", "left_semi").dropDuplicates(["rid"]), "labelled")
    terms = materialize(rows.mapInArrow(_terms, _TERMS).groupBy("term", "half").agg(
        *(F.sum(c).alias(c) for c in ("a", "b", "da", "db"))), "terms")
    weights = _weights(terms, (0, 1))
    if weights is None:
        return Model({t: float(np.log(s)) for t, s in lexicon().items()})
    model = Model(weights)
    shared = spark.sparkContext.broadcast([Model(_weights(terms, (1 - h,)) or weights) for h in (0, 1)])

    def levels(batches):
        for b in batches:
            level = [shared.value[rid & 1].level(t)[0] for rid, t in zip(b.column("rid").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("rid"), pa.array(level, pa.float64())], ["y", "rid", "level"])
    got = rows.select("y", "rid", "text").mapInArrow(levels, "y int, rid long, level double").orderBy("rid", "y").limit(2 * sample).toArrow()
    model.slope, model.shift = curve(got.column("level").to_numpy(), got.column("y").to_numpy())
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_terms for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # lexicon and at most EXTRA_TERMS terms

    def run(batches):
        for b in batches:
            found = [shared.value.level(t.as_py()) for t in b.column("text")]
            s = shared.value.scores(np.array([x for x, _ in found]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)),
                 pa.array([n for _, n in found], pa.int64())], ["doc_id", "held_out", "score", "predicted", "n_terms"])
    return (docs.select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_terms long"))
