"""Toxicity scores from a learned lexicon that is matched with misspellings, in context.

Terms and stems that mark toxic documents are learned from labelled rows. Their trie
is run against each distinct word together with a Levenshtein automaton; the product
is determinised as far as words need it. Hits are weighed by their surroundings, as a
quotation is no abuse, and a logistic model on the weights gives the score.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPLIT_WORDS, pick
from tidemark.llm.hashing import compacted
from tidemark.llm.tokens import chunks
from tidemark.session import written

#: Words on each side of a hit that are its context.
WINDOW = 8
#: Automaton states and words remembered by a worker.
MOST_STATES, MOST_WORDS = 50_000, 150_000
STEMS = (4, 5, 6, 7, 8)
FEATURES = ("abuse", "near", "quoted", "share")
#: What each edit leaves of a hit's weight; the model can take more off by the feature ``near``.
EDIT_DISCOUNT = 0.6

_RUN = re.compile(r"[^\W_]+")
_OPENS, _CLOSES = "\"'“”„«»‘‹", "\"'“”»«’›"
#: Verbs of report, which announce a quotation.
_REPORTS = frozenset("said says quoted quote wrote called dit cite sagte zitat dijo cita".split())


def terms_of(word: str) -> list[str]:
    """The runs of letters and digits in a word, and what is left of it without other signs."""
    low = word.lower()
    runs = _RUN.findall(low)
    whole = "".join(runs)
    return runs if len(runs) < 2 else [*runs, whole]


def allowed(term: str) -> int:
    """Edits that a term of this length may differ by."""
    n = len(term.rstrip("*"))
    return 0 if n < 5 or term.endswith("*") else 1 if n < 10 else 2


class LexiconAutomaton:
    """The trie of a lexicon crossed with edit counts, as a deterministic automaton built on demand.

    A state is a set of trie nodes, each with the fewest edits that reach it. A term
    that ends in an asterisk is a stem, which takes any ending.
    """

    def __init__(self, lexicon: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.limit = [0]
        for term in sorted(lexicon):
            node, k = 0, allowed(term)
            self.limit[0] = max(self.limit[0], k)
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], k)
            self.ends[node] = term
        self.states: dict[frozenset, dict[str, frozenset]] = {}
        self.start = self._closed({0: 0})

    def _closed(self, found: dict[int, int]) -> frozenset:
        """With the nodes reached by leaving out letters of a term."""
        queue = list(found)
        while queue:
            node = queue.pop()
            for child in self.children[node].values():
                e = found[node] + 1
                if e <= self.limit[child] and e < found.get(child, 99):
                    found[child] = e
                    queue.append(child)
        return frozenset(found.items())

    def _step(self, state: frozenset, c: str) -> frozenset:
        found: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self.limit[node] and e < found.get(node, 99):
                found[node] = e

        for node, e in state:
            if (end := self.ends[node]) is not None and end.endswith("*") and e == 0:
                reach(node, 0)  # a stem goes on
            reach(node, e + 1)
            for letter, child in self.children[node].items():
                reach(child, e + (letter != c))
        return self._closed(found)

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest term and its edits; ties by the term."""
        state = self.start
        for c in word:
            row = self.states.get(state)
            if row is None:
                if len(self.states) >= MOST_STATES:
                    self.states.clear()
                row = self.states[state] = {}
            state = row.get(c) or row.setdefault(c, self._step(state, c))
            if not state:
                return None
        hits = [(e, end) for node, e in state if (end := self.ends[node]) is not None and e <= allowed(end)]
        return (lambda x: (x[1], x[0]))(min(hits)) if hits else None


@dataclass
class Model:
    """What scoring needs; its size does not depend on the corpus."""

    weights: dict[str, float] = field(default_factory=dict)  # by term
    harmless: frozenset[str] = frozenset()  # words near a term that clean texts use
    factors: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    bias: float = -30.0


class Scorer:
    """Finds hits in texts; remembers words."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = LexiconAutomaton(list(model.weights))
        self.known: dict[str, tuple[float, int] | None] = {}

    def hit(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of a whole word's best hit."""
        best = None
        for run in terms_of(word):
            found = self.automaton.match(run)
            if found and (found[1] == 0 or run not in self.model.harmless):
                w = self.model.weights[found[0]]
                if best is None or (-found[1], w) > (-best[1], best[0]):
                    best = (w, found[1])
        return best

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row of FEATURES for each text."""
        words = pc.ascii_split_whitespace(compacted(texts)[2])
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        flat = words.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        if len(self.known) + len(distinct) > MOST_WORDS:
            self.known.clear()
        for w in distinct:
            if w not in self.known:
                self.known[w] = self.hit(w)
        out = np.zeros((len(texts), len(FEATURES)))
        marked = np.fromiter((self.known[w] is not None for w in distinct), bool, len(distinct))
        if not marked.any():
            return out
        codes = flat.indices.to_numpy()
        for place in np.flatnonzero(marked[codes]):
            text = int(np.searchsorted(bounds, place, "right")) - 1
            a, b = max(bounds[text], place - WINDOW), min(bounds[text + 1], place + WINDOW + 1)
            before = [distinct[c] for c in codes[a : place + 1]]
            after = [distinct[c] for c in codes[place:b]]
            weight, edits = self.known[distinct[codes[place]]]
            if quoted(before, after):
                out[text, 2] += weight
            else:
                out[text, 0] += weight * EDIT_DISCOUNT**edits
                out[text, 1] += weight if edits else 0
        size = np.maximum(np.diff(bounds), 1)
        out[:, 3] = out[:, 0] / size * 100
        return np.log1p(out)

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = self.features(texts) @ np.array(self.model.factors) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def quoted(before: list[str], after: list[str]) -> bool:
    """Whether a hit (last of ``before``, first of ``after``) stands in quotation marks or follows a verb of report."""
    opened = any(w[:1] in _OPENS for w in before if w)
    closed = any(w.rstrip(".,;:!?")[-1:] in _CLOSES for w in after if w.rstrip(".,;:!?"))
    reported = any(w.strip(".,;:!?\"'").lower() in _REPORTS for w in before[:-1])
    return (opened and closed) or (reported and (opened or closed))


def training_rows(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, label) of about ``most`` rows of each label at most, chosen by a hash of the id.

    An id whose crc32 leaves 2 modulo 4 is held out. An id that is labelled several times
    is toxic if any label says so.
    """
    marks = pick(labels, key=id_col, label=label_col).where("key IS NOT NULL AND label IS NOT NULL AND crc32(cast(key AS string)) % 4 <> 2")
    marks = marks.groupBy("key").agg(F.max("label").alias("label"))
    sizes = {r.label: r.n for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r.label in (0, 1)}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(most / n)).otherwise(share)
    chosen = marks.where((F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))) < share)
    # about 2 * most rows of an id and a label, whatever the corpus holds
    found = pick(docs, key=id_col, text=text_col).join(F.broadcast(chosen), "key").select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int"))
    # copies with few changes are no independent evidence: most share the smallest hash of two neighbouring words
    words = F.split(F.lower("text"), SPLIT_WORDS)
    least = F.get(F.transform(F.array(words), lambda ws: F.array_min(F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1))))), 0)
    return found.withColumn("least", least).groupBy("least", "label").agg(F.min("text").alias("text")).select("text", "label")


def merged(strong: DataFrame) -> DataFrame:
    """The (term, odds) that say something of their own: stems of at least two words, no longer stems, and the other words.

    A stem which only ever stands for one term is no stem.
    """
    words, stems = (strong.where(F.col("term").endswith("*") == is_stem) for is_stem in (False, True))

    def begun(df: DataFrame, length: Column, beyond: int) -> DataFrame:
        """Each term with the stems that it begins with and is longer than by ``beyond`` letters or more."""
        sizes = F.filter(F.array(*(F.lit(n) for n in STEMS)), lambda n: n + beyond <= length)
        return df.select("term", F.explode(F.transform(sizes, lambda n: F.concat(F.substring("term", F.lit(1), n), F.lit("*")))).alias("stem"))

    spread = begun(words, F.length("term"), 0).groupBy("stem").agg(F.count(F.lit(1)).alias("words")).where("words >= 2").select("stem")
    stems = stems.join(spread, stems.term == spread.stem, "left_semi")
    # the asterisk is one character of a stem
    longer = begun(stems, F.length("term") - 1, 1).join(stems.select(F.col("term").alias("stem")), "stem").select("term").distinct()
    covered = begun(words, F.length("term"), 1).join(stems.select(F.col("term").alias("stem")), "stem").select("term").distinct()
    return stems.join(longer, "term", "left_anti").unionByName(words.join(covered, "term", "left_anti"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of at most about ``sample_rows`` labelled rows of each label that are not held out.

    Without rows of both labels, the model scores every text near 0.
    """
    spark = docs.sparkSession
    sample = written(training_rows(docs, labels, sample_rows, id_col, text_col, label_col), "toxic_sample")
    total = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return Model()

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                own = {t for w in set(text.split()) for t in terms_of(w)}
                for t in own | {t[:n] + "*" for t in own for n in STEMS if len(t) > n}:
                    counts[t][label] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())],
                names=["term", "bad", "good"],
            )

    terms = sample.mapInArrow(used, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    terms = written(terms, "toxic_terms")
    # weight of evidence with half a document added, of terms whose counts are too uneven
    # for chance even as the most uneven of so many terms
    odds = F.log((F.col("bad") + 0.5) / (total[1] + 1)) - F.log((F.col("good") + 0.5) / (total[0] + 1))
    base = total[1] / (total[0] + total[1])
    seen = F.col("bad") + F.col("good")
    uneven = F.col("bad") * F.log(F.col("bad") / (seen * base))
    uneven += F.when(F.col("good") == 0, F.lit(0.0)).otherwise(F.col("good") * F.log(F.col("good") / (seen * (1 - base))))
    strong = terms.where((F.col("bad") >= 3) & (odds >= 3.0) & (uneven >= math.log(max(1, terms.count())) + 3))
    weights = {r.term: r.odds for r in merged(strong.select("term", odds.alias("odds"))).orderBy("term").collect()}
    if not weights:
        return Model()

    def confusable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(list(weights))
        for batch in batches:
            near = [(m := automaton.match(t)) is not None and m[1] > 0 for t in batch.column("term").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("term").filter(pa.array(near, pa.bool_()))], names=["term"])

    clean = terms.where((F.col("good") > 0) & (odds < 3.0) & ~F.col("term").endswith("*")).select("term")
    model = Model(weights, frozenset(r.term for r in clean.mapInArrow(confusable, "term string").collect()))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in chunks(batch, "text"):
                x = scorer.features(part.column("text"))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(x.shape[1])), part.column("label")], names=[*FEATURES, "label"])

    schema = T.StructType([*(T.StructField(f, T.DoubleType()) for f in FEATURES), T.StructField("label", T.IntegerType())])
    distinct = sample.mapInArrow(featured, schema).groupBy(*FEATURES, "label").agg(F.count(F.lit(1)).alias("n"))
    rows = np.array([tuple(r) for r in distinct.orderBy(*FEATURES, "label").collect()], float).reshape(-1, len(FEATURES) + 2)
    model.factors, model.bias = logistic(rows[:, : len(FEATURES)], rows[:, -2], rows[:, -1])
    return model


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1, steps: int = 50) -> tuple[list[float], float]:
    """Ridge logistic regression by Newton's method; ``n``: how often each row counts."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (n * (p - y)) + penalty * w
        step = np.linalg.solve((z * (n * p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        step *= min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        w -= step
        if math.isclose(float(np.abs(step).max()), 0, abs_tol=1e-9):
            break
    return [float(v) for v in w[:-1]], float(w[-1])


def scored(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row, over whole texts.

    A null or empty text gets the score of a text without hits. Repeated rows are
    scored each; other columns are ignored; an empty table gives an empty table.
    """
    docs = pick(df, doc_id=id_col, text=text_col)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(model)
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own.scores(part.column("text")))], names=schema.names)

    return docs.mapInArrow(score, schema)


def without_toxic(df: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text scores ``threshold`` or more; all columns and clean rows are kept."""
    place = df.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(model)
        for batch in batches:
            for part in chunks(batch, f"_c{place}"):
                yield part.filter(pa.array(own.scores(part.column(place)) < threshold))

    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return plain.mapInArrow(clean, plain.schema).toDF(*df.columns)
