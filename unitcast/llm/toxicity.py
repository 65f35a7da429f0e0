"""Toxicity: gradient-boosted trees over dense features of a text, with
isotonic calibration.

1. Labelled ids outside the held-out fold (``fold_of``: crc32 of the id
   modulo ``FOLDS`` is not 0) are sampled: the ``SAMPLE`` smallest by hash if
   there are more.  Of their texts every different one counts once.
2. Lexicon: terms of the sample are whole words and word beginnings (inflected
   words share them).  Grouped sums of their documents by fold and label give
   a smoothed log odds ratio; terms of at least ``SUPPORT`` toxic texts and
   ``ODDS`` are kept, the ``TERMS`` with the strongest evidence.  A training
   row is never rated by a lexicon that saw its own fold.
3. Features (``FEATURES``): densities of the lexicon by strength, how close its
   words stand to the second person, capitals, punctuation, and obfuscation
   (signs or digits inside words, stretched letters, lexicon words that appear
   only once these are undone).
4. Two ensembles of boosted trees, each fitted on half of the training folds;
   their margins on the other half, out of sample, fit the isotonic
   calibration.  A text's margin is the mean of both.  Within a step of the
   calibration the margin decides the order (``TIE``).

Only words, never a label, language, source or id, reach the score.  The whole
text of every row is read.

Edge cases: a null text is an empty text and is scored; a null id counts as
the empty string and has no label; repeated labels of an id count as toxic if
one is; a label that is null or has no document is ignored; without labelled
texts of both classes in both halves every score is their share of toxic texts
(0 without any); an empty table gives an empty result; extra columns are kept
(one named like a result is replaced).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitcast.llm import common

FOLDS = 5                   # the first of them is held out
SAMPLE = 20_000             # labelled ids, and different texts, that a model is fitted on, at most
TERMS = 20_000              # lexicon entries, at most
SUPPORT = 3                 # toxic texts that hold a term, at least
ODDS = 1.0                  # log odds ratio of a term, at least
STRONG, MEDIUM = 3.5, 2.0   # log odds ratios of the lexicon's tiers
STEMS = (4, 5, 6, 7)         # code points of word beginnings that are terms
CLOSE = 5                   # words between a lexicon word and the second person
TREES, DEPTH, RATE = 20, 3, 0.3
SEED = 20
TIE = 1e-3
TERMS_HELD = 200_000        # counted terms that a task holds before it hands them on

FEATURES = ["strong", "medium", "mild", "distinct", "heaviest", "second_person", "near_second_person",
            "capitals", "shouted", "exclamations", "signs", "mixed_words", "stretched", "hidden", "log_words"]

# Pronouns and possessives of the second person, by language.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves "               # English
    "du dich dir dein deine deinen deiner deinem euch euer eure ihr "    # German
    "tu te toi ton ta tes vous votre vos "              # French
    "tú ti tuyo tuya usted ustedes vosotros vuestro vuestra "   # Spanish
    .split())

# Signs that stand for letters.
STAND_INS = str.maketrans("013457@$!|", "oieastasii")

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][\d@$!|*._\-]+[^\W\d_]|[013457@$][^\W\d_]{2}")
_STRETCHED = re.compile(r"([^\W\d_])\1\1+")
_SHOUTED = re.compile(r"[A-ZÀ-ÖØ-Þ]{3,}")
_INNER = re.compile(r"[\W\d_]+")
_ENDS = ".,;:!?)"
_EDGES = _ENDS + "(\"'[]{}<>"
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,")


def terms_of(word: str) -> list[str]:
    """A word and its beginnings (marked by a trailing ``*``)."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


class Lexicon:
    """Weights of terms, and of words by their heaviest term; a word is rated
    once and remembered."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.heads = {term.rstrip("*")[:STEMS[0]] for term in weights}     # how words with a weight begin
        self.words: dict[str, float] = {}
        self.stretched: dict[str, float] = {}       # word with a stretched letter -> weight without

    def weight(self, word: str) -> float:
        return max([self.weights.get(t, 0.0) for t in terms_of(word)]) if word[:STEMS[0]] in self.heads else 0.0

    def __call__(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= TERMS_HELD:
                self.words.clear()
                self.stretched.clear()
            found = self.words[word] = self.weight(word)
            if _STRETCHED.search(word):
                self.stretched[word] = self.weight(_STRETCHED.sub(r"\1", word))
        return found


def words_of(low: str) -> tuple[list[str], list[str]]:
    """Words of a lower-cased text in order, and the tokens in which signs or
    digits stand between or for letters."""
    words, mixed = [], []
    for token in low.split():
        if token.isalpha():
            words.append(token)
        elif token[-1] in _ENDS and token[:-1].isalpha():
            words.append(token[:-1])
        else:
            words += _WORD.findall(token)
            core = token.strip(_EDGES)
            if _MIXED.search(core):
                mixed.append(core)
    return words, mixed


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES`` of a text."""
    words, mixed = words_of(text.lower())
    counts = Counter(words)
    known, hits = lexicon.words.get, {}
    for w in counts:
        x = known(w)
        if x is None:
            x = lexicon(w)
        if x:
            hits[w] = x
    strong = sum(counts[w] for w, x in hits.items() if x >= STRONG)
    medium = sum(counts[w] for w, x in hits.items() if MEDIUM <= x < STRONG)
    mild = sum(counts[w] for w, x in hits.items() if x < MEDIUM)
    persons = sum([counts[w] for w in SECOND_PERSON if w in counts])
    near = 0
    if hits and persons:
        places = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        for i, w in enumerate(words):
            if w in hits:
                at = bisect_left(places, i - CLOSE)
                near += at < len(places) and places[at] <= i + CLOSE
    hidden = 0
    for token in mixed:     # undone obfuscation that gives a lexicon word
        plain = _INNER.sub("", token.translate(STAND_INS))
        hidden += lexicon(plain) >= MEDIUM or lexicon.stretched.get(plain, 0.0) >= MEDIUM
    stretched = [w for w in counts if w in lexicon.stretched] if lexicon.stretched else []
    hidden += sum(counts[w] for w in stretched if lexicon.stretched[w] >= MEDIUM)
    data = text.encode("utf-8", "surrogatepass")
    letters = len(data) - len(data.translate(None, _LETTERS))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    signs = len(data) - len(data.translate(None, _SIGNS))
    shouted = len(_SHOUTED.findall(text))
    per_hundred = 100.0 / max(1, len(words))
    return [strong * per_hundred, medium * per_hundred, mild * per_hundred, float(len(hits)), max(hits.values(), default=0.0),
            persons * per_hundred, near * per_hundred, capitals / max(1, letters), shouted * per_hundred,
            text.count("!") * per_hundred, signs / max(1, len(data)), len(mixed) * per_hundred,
            sum(counts[w] for w in stretched) * per_hundred, float(hidden), math.log1p(len(words))]


def fold_of(id_col: str) -> Column:
    """Fold of a row: the unsigned crc32 of its id as text, modulo ``FOLDS``; 0 is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``(_text, _fold, _label)``: the bounded sample of different labelled texts outside the held-out fold."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_of")).agg(F.max(F.col(label_col).cast("int")).alias("_label")))
    known = known.withColumn("_fold", fold_of("_of").cast("int")).filter("_fold != 0")
    known = known.orderBy(F.xxhash64("_of"), "_of").limit(SAMPLE)
    known = F.broadcast(common.stored(known, "labelled"))       # at most SAMPLE rows of three numbers
    texts = docs.select(F.col(id_col).alias("_of"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(known, "_of")
    texts = texts.withColumn("_digest", F.md5(F.col("_text").cast("binary")))
    chosen = (texts.groupBy("_digest").agg(F.min("_fold").alias("_fold"), F.max("_label").alias("_label"), F.min("_of").alias("_of"))
              .orderBy("_digest").limit(SAMPLE))
    chosen = F.broadcast(common.stored(chosen, "chosen"))       # at most SAMPLE short rows
    found = texts.select("_of", "_digest", "_text").join(chosen, ["_of", "_digest"])
    found = found.dropDuplicates(["_digest"]).select("_text", "_fold", "_label")
    return common.stored(found, "labelled-texts")


def term_counts(texts: DataFrame) -> DataFrame:
    """``(term, t1 .. , c1 ..)``: toxic and clean texts of each training fold that hold a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            return pa.record_batch([pa.array([k[0] for k in held]), pa.array([k[1] for k in held], pa.int32()),
                                    pa.array(list(held.values()), pa.int64())], names=["term", "_cell", "_n"])

        for batch in common.slices(batches):
            for text, fold, label in zip(*(c.to_pylist() for c in batch.columns)):
                cell = 2 * fold + (label > 0)
                held.update({(t, cell) for w in set(words_of(text.lower())[0]) for t in terms_of(w)})
            if len(held) >= TERMS_HELD:
                yield handed()
                held.clear()
        if held:
            yield handed()

    cells = texts.mapInArrow(run, "term string, _cell int, _n long")
    return cells.groupBy("term").agg(*[
        F.sum(F.when(F.col("_cell") == 2 * f + k, F.col("_n")).otherwise(0)).alias(f"{'ct'[k]}{f}")
        for f in range(1, FOLDS) for k in (0, 1)])


def _odds(toxic, clean, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def lexicons(texts: DataFrame) -> list[dict[str, float]]:
    """Weights of terms: first those learned from all training folds, then one
    lexicon per training fold that leaves this fold out."""
    sizes = {(r["_fold"], r["_label"]): r["n"] for r in
             texts.groupBy("_fold", (F.col("_label") > 0).cast("int").alias("_label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sum((F.col(f"t{f}") for f in range(1, FOLDS)), F.lit(0)), sum((F.col(f"c{f}") for f in range(1, FOLDS)), F.lit(0))
    every = [sum(sizes.get((f, k), 0) for f in range(1, FOLDS)) for k in (0, 1)]
    odds = F.log((toxic + 0.5) / (every[1] + 1)) - F.log((clean + 0.5) / (every[0] + 1))
    held = (term_counts(texts).withColumn("_odds", odds).filter((toxic >= SUPPORT) & (F.col("_odds") >= ODDS))
            .orderBy((F.col("_odds") * F.sqrt(toxic)).desc(), "term").limit(TERMS).collect())     # at most TERMS rows
    out = []
    for left_out in range(FOLDS):
        folds = [f for f in range(1, FOLDS) if f != left_out]
        n = [sum(sizes.get((f, k), 0) for f in folds) for k in (0, 1)]
        weights = {}
        for r in held:
            t, c = sum(r[f"t{f}"] for f in folds), sum(r[f"c{f}"] for f in folds)
            if t >= SUPPORT and (odds := _odds(t, c, n[1], n[0])) >= ODDS:
                weights[r["term"]] = odds
        out.append(weights)
    return out


def _rated(df: DataFrame, text_col: str, fold_col: str | None, weights: list[dict[str, float]]) -> DataFrame:
    """Replace ``text_col`` by ``_values``, the features; rated by the lexicon
    that leaves out the row's fold, or by the whole one without ``fold_col``."""
    shared = df.sparkSession.sparkContext.broadcast(weights)
    rest = [c for c in df.columns if c != text_col]
    at = df.columns.index(text_col)
    fold_at = df.columns.index(fold_col) if fold_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Lexicon(w) for w in shared.value]
        for batch in common.slices(batches):
            folds = batch.column(fold_at).to_pylist() if fold_at is not None else [0] * batch.num_rows
            values = [features(t.as_py(), known[f]) for t, f in zip(batch.column(at), folds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest) + 1) if i != at),
                                              pa.array(values, pa.list_(pa.float64()))], names=[*rest, "_values"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)
    return df.mapInArrow(run, f"{schema}{', ' if schema else ''}_values array<double>")


@dataclass
class Toxicity:
    """A fitted scorer: lexicons, both ensembles, calibration; or only a share."""
    weights: list[dict[str, float]]
    ensembles: list[Model]
    calibration: Model | None
    share: float


def _margin(rows: DataFrame, ensembles: list[Model], name: str = "_margin") -> DataFrame:
    """Mean margin of the ensembles over ``_values``."""
    out = rows.withColumn("_features", array_to_vector("_values"))
    for i, model in enumerate(ensembles):
        out = model.transform(out).withColumn(f"_m{i}", vector_to_array("_raw")[1]).drop("_raw", "_p", "_class")
    n = range(len(ensembles))
    return out.withColumn(name, sum((F.col(f"_m{i}") for i in n), F.lit(0.0)) / len(ensembles)).drop("_features", *[f"_m{i}" for i in n])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Toxicity:
    """Learn from the labelled documents outside the held-out fold."""
    texts = training_texts(docs, labels, id_col, text_col, label_col)
    weights = lexicons(texts)
    rows = common.stored(_rated(texts, "_text", "_fold", weights), "training-rows")
    rows = rows.withColumn("_half", F.col("_fold") % 2).withColumn("_y", (F.col("_label") > 0).cast("double"))
    seen = {(r["_half"], r["_y"]): r["n"] for r in rows.groupBy("_half", "_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(seen.values())
    share = sum(n for (_, y), n in seen.items() if y > 0) / total if total else 0.0
    if len(seen) < 4:       # a half without one of the classes
        return Toxicity(weights, [], None, share)
    trees = GBTClassifier(featuresCol="_features", labelCol="_y", predictionCol="_class", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=RATE, minInstancesPerNode=2, seed=SEED)
    ready = rows.withColumn("_features", array_to_vector("_values")).select("_half", "_y", "_features").coalesce(4)
    ensembles = [trees.fit(ready.filter(F.col("_half") == half)).setRawPredictionCol("_raw").setProbabilityCol("_p")
                 for half in (0, 1)]
    apart = [_margin(rows.filter(F.col("_half") != half), [ensembles[half]]) for half in (0, 1)]
    margins = apart[0].unionByName(apart[1]).select("_margin", "_y").coalesce(1)     # at most SAMPLE rows
    calibration = IsotonicRegression(featuresCol="_margin", labelCol="_y", predictionCol="_calibrated").fit(margins)
    return Toxicity(weights, ensembles, calibration, share)


def score(model: Toxicity, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5
    on) to the rows of ``docs``; the text itself is left out."""
    rest = [c for c in docs.columns if c not in (text_col, "held_out", "score", "predicted")]
    plain = docs.select(*rest, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    if model.calibration is None:
        out = plain.drop("_text").withColumn("score", F.lit(float(model.share)))
    else:
        rated = _margin(_rated(plain, "_text", None, model.weights[:1]), model.ensembles)
        squashed = 1 / (1 + F.exp(-2 * F.col("_margin")))
        out = (model.calibration.transform(rated)
               .withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_calibrated") * (1 - TIE) + squashed * TIE))))
    return out.select(*rest, (fold_of(id_col) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
