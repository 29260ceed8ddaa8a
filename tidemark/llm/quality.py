"""Quality rules applied as a cascade that stops at the first rule a text breaks.

A rule compares measures of a text. What each measure costs, and how many texts each rule rejects, is estimated on
a sample; rules are tried in order of rejections per cost, the cost of a rule being that of all
measures it needs. The order decides how much work is done, never the verdict.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, SPLIT_WORDS, packed, pick, unpacked
from tidemark.session import discard, written

#: Seconds that a timed job takes at least, by repeating the sample; and how often each is timed.
TIMED_SECONDS, TIMED_RUNS = 0.1, 3


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the columns of the measures that ``needs`` names, and is true for a text that the rule rejects."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[..., Column]


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in the text."""

    def places(windows: Column) -> Column:
        # equal windows stand next to each other after sorting
        def same(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(windows, k).w == F.get(windows, other).w, F.lit(False))

        found = F.filter(F.sequence(F.lit(0), F.size(windows) - 1), lambda k: same(k, k + 1) | ((k > 0) & same(k, F.greatest(k - 1, F.lit(0)))))
        return F.sort_array(F.transform(found, lambda k: F.get(windows, k).i))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        windows = F.transform(starts, lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

        def of_windows(v: Column) -> Column:
            marked = F.transform(v, lambda x, i: F.struct(x.alias("w"), i.alias("i")))
            repeats = _bind(F.sort_array(marked), lambda s: _bind(places(s), covered))
            return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(repeats)

        return F.when(F.size(w) < 3, F.lit(0)).otherwise(_bind(windows, of_windows))

    return _bind(words, of_words)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) for every row, over whole texts.

    A null text counts as an empty one.
    """
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    counted = _bind(_words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    return docs.select(
        "doc_id",
        "text",
        counted.alias("counted"),
        *[MEASURES[n](F.col("text")).alias(n) for n in ("word_chars", "n_symbols", "n_dup_lines")],
    ).select(
        "doc_id",
        "text",
        F.col("counted.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("counted.r").cast("long").alias("n_repeat_words"),
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPLIT_WORDS), lambda w: w != "")


#: Measures by name, each of a text.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda t: F.size(_words(t)).cast("long"),
    "word_chars": lambda t: F.length(F.translate(t, BLANKS, "")).cast("long"),
    "n_symbols": lambda t: _count_of(t, "#*$%&|<>"),
    "n_lines": lambda t: F.size(_lines(t)),
    "n_dup_lines": lambda t: _bind(_lines(t), lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long"),
    "n_repeat_words": lambda t: _repeated(_words(t)).cast("long"),
    "n_letters": lambda t: F.length(F.regexp_replace(t, r"[^\p{L}]+", "")),
    "n_capitals": lambda t: F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
    "n_exclamations": lambda t: _count_of(t, "!"),
    "n_wordless": lambda t: F.size(F.regexp_extract_all(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"), F.lit(0))),
}
#: What every text's verdict is returned with.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def standard_rules() -> list[Rule]:
    """Thresholds in whole numbers, so that no rounding can turn a verdict."""
    return [
        Rule("few_words", ("n_words",), lambda n: n < 50),
        Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
        Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 100 * s > 10 * n),
        Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, lines: 100 * d > 50 * lines),
        Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 15 * n)),
        Rule("capitals", ("n_capitals", "n_letters"), lambda c, letters: 100 * c > 30 * letters),
        Rule("exclamations", ("n_exclamations", "n_words"), lambda e, n: 100 * e > 20 * n),
        Rule("wordless", ("n_wordless", "n_words"), lambda w, n: 100 * w > 20 * n),
    ]


def broken(rule: Rule, known: tuple[str, ...] = ()) -> Column:
    """Whether the text breaks the rule; ``known`` measures are columns, others are taken of the text only here."""
    return rule.fails(*(F.col(n) if n in known else MEASURES[n](F.col("text")) for n in rule.needs))


def measured_costs(sample: DataFrame, names: set[str]) -> dict[str, float]:
    """Seconds for one pass of each measure over the sample.

    The sample is repeated until a pass takes long enough to be told from the job around it, and the shortest of
    several passes counts.
    """

    def seconds(value: Column, times: int) -> float:
        rows = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("i"))
        began = time.perf_counter()
        rows.agg(F.sum(value)).collect()
        return time.perf_counter() - began

    idle, costs = F.length("text"), {}
    seconds(idle, 1)
    for name in sorted(names):
        value, times = MEASURES[name](F.col("text")), 1
        seconds(value, 1)  # code is made ready
        while times < 256 and seconds(value, times) < TIMED_SECONDS:
            times *= 4
        spent = min(seconds(value, times) for _ in range(TIMED_RUNS)) - min(seconds(idle, times) for _ in range(TIMED_RUNS))
        costs[name] = max(spent / times, 1e-5)
    return costs


def ordered_rules(sample: DataFrame, rules: list[Rule], costs: Mapping[str, float] | None = None) -> list[Rule]:
    """``rules`` by falling rejections per cost on a sample (text), rounded to powers of four; ties by name.

    Rules that reject nothing come last: their order saves no work.
    """
    needed = {n for r in rules for n in r.needs}
    costs = measured_costs(sample, needed) if costs is None else costs
    table = sample.select(*[MEASURES[n](F.col("text")).alias(n) for n in sorted(needed)])
    counts = table.agg(*[F.count_if(broken(r, tuple(needed))).alias(f"r{i}") for i, r in enumerate(rules)]).first()
    cost = {r.name: sum(costs[n] for n in r.needs) for r in rules}
    gain = {r.name: round(math.log(counts[i] / cost[r.name], 4)) if counts[i] else -math.inf for i, r in enumerate(rules)}
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def cascade(rules: list[Rule], known: tuple[str, ...] = ()) -> Column:
    """True for a text that no rule rejects; rules after the first broken one, and their measures, are not evaluated."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(broken(rule, known), F.lit(False)).otherwise(verdict)
    return verdict


def _sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About so many rows by a hash of id and text, stored."""
    share = rows / max(1, docs.count())
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))
    return written(chosen.select("text"), "quality_sample")


def _order(docs: DataFrame, rules: list[Rule] | None, rows: int) -> list[Rule]:
    sample = _sampled(docs, rows)
    order = ordered_rules(sample, standard_rules() if rules is None else rules)
    discard(sample)
    return order


def quality_verdicts(
    df: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The measures of every text, ``base_failed`` and ``kept``.

    Costs and rejections are estimated on about ``sample_rows`` rows by a hash. A null or empty text has no words
    and is rejected by the standard rules. Repeated rows each get their verdict; other columns are ignored; an empty table
    gives an empty table. The measures that are returned are taken of all texts; the cascade saves the others.
    """
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    order = _order(docs, rules, sample_rows)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured(df, id_col, text_col).withColumns({"base_failed": base_failed, "kept": cascade(order, REPORTED)}).drop("text")


def without_rejected(df: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule rejects, all columns kept: here the cascade saves every measure after the first broken rule."""
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    verdict = cascade(_order(docs, rules, sample_rows))
    rows = packed(df, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return unpacked(rows.where(verdict), df.columns, {}, {})
