"""Quality rules as a short-circuit cascade: the rule that rejects most per second goes first.

A document is kept if no rule rejects it.  The verdict does not depend on the order of the rules, the time
does: they are tried one after the other, and a rejected document is spared the rest.

1. Sample: a share of the documents, drawn so that about ``sample_rows`` come, is written to the shared folder.
2. Cost: each rule runs alone over the sample, against a run without any rule.
3. Selectivity: all rules mark the sample at once; the marks are counted by pattern.
4. Order: of the rules left, the one with the most rejections per second among the sample's documents that the
   rules before it let through; rules that reject nothing more go last, cheapest first.
5. Cascade: one ``CASE WHEN`` over all documents in that order, which stops at the first rule that rejects.

Rules are conditions on *measures* of the text.  On plain documents (``cascade``) a measure is computed where a
rule asks for it and not at all for documents rejected before; after ``measure`` the rules read its columns.
SQL functions only; no shuffle beside the sample's counts.

Rules for odd rows: NULL and empty texts have no words, so ``few_words`` rejects them; repeated rows are each
judged alone; an empty table gives no rows and the rules' given order; a column with the name of a result gives
way.  Words are runs of characters other than ASCII white space, compared as they are.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.llm.common import let, saved, without

SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"

#: Documents that a sample holds on average, and the seed of its draw.
SAMPLE_ROWS, SAMPLE_SEED = 2_000, 11


def _words(text: Column) -> Column:
    return F.split(F.trim(text, F.lit(SPACES)), SPACE + "+")


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _full_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(SPACES)) != "")


def _window(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)]


def _neighbours(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The positions ``p`` of those of ``ordered`` that are the same as the one before or behind."""
    pairs = F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), lambda a, b: F.coalesce(same(a, b), F.lit(False)))
    either = lambda flags, i: F.get(flags, i) | F.coalesce(F.get(flags, i - 1), F.lit(False))
    return let(pairs, lambda flags: F.transform(F.filter(ordered, lambda x, i: either(flags, i)), lambda x: x["p"]))


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that the array ``words`` holds twice or more.

    Windows of equal hash are the candidates; their words themselves decide.
    """
    hashes = F.transform(F.slice(words, 1, F.size(words) - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    by_hash = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    by_words = lambda at: F.sort_array(F.transform(at, lambda i: F.struct(F.array(*_window(words, i)).alias("w"), i.alias("p"))))
    candidates = lambda h: let(by_hash(h), lambda o: _neighbours(o, lambda a, b: a["h"] == b["h"]))
    true = lambda at: let(by_words(at), lambda o: F.sort_array(_neighbours(o, lambda a, b: a["w"] == b["w"])))
    reach = lambda at: F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))).cast("long"))
    covered = lambda at: F.aggregate(reach(at), F.lit(0).cast("long"), lambda total, x: total + x)
    found = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(let(candidates(h), true), covered)).otherwise(F.lit(0).cast("long"))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(hashes, found))


#: Measures of a text that is not NULL.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": _n_words,
    "word_chars": lambda t: F.length(F.translate(t, SPACES, "")).cast("long"),
    "n_symbols": lambda t: F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
    "n_dup_lines": lambda t: let(_full_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda t: let(_words(t), _repeat_words),
    "n_lines": lambda t: F.size(_full_lines(t)).cast("long"),
    # words of two or more letters, none of them small
    "n_shouts": lambda t: F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D\p{L}]*\p{Lu}){2}[^\x20\x09-\x0D\p{Ll}]*(?![^\x20\x09-\x0D])")).cast("long"),
    "n_letter_words": lambda t: F.regexp_count(t, F.lit(r"\p{L}[^\x20\x09-\x0D]*")).cast("long"),
    "n_digits": lambda t: F.regexp_count(t, F.lit("[0-9]")).cast("long"),
    "n_dotted_lines": lambda t: F.regexp_count(t, F.lit(r"(?:\.\.\.|…)[\x20\x09\x0B-\x0D]*(?=\n|\z)")).cast("long"),
    "n_fillers": lambda t: F.regexp_count(t, F.lit(r"(?i)lorem ipsum")).cast("long"),
}

#: The measures that ``measure`` gives for every document.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

Measures = Mapping[str, Column]

#: Rules: which documents go, in whole numbers so that every engine agrees.
RULES: dict[str, Callable[[Measures], Column]] = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_words": lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 50,
    "symbols": lambda m: m["n_symbols"] * 100 > m["n_words"] * 10,
    "short_words": lambda m: m["word_chars"] < m["n_words"] * 3,
    "long_words": lambda m: m["word_chars"] > m["n_words"] * 10,
    "repeated_lines": lambda m: m["n_dup_lines"] * 100 > m["n_lines"] * 50,
    "shouting": lambda m: m["n_shouts"] * 100 > m["n_words"] * 30,
    "no_letters": lambda m: m["n_letter_words"] * 100 < m["n_words"] * 60,
    "digits": lambda m: m["n_digits"] * 100 > m["word_chars"] * 50,
    "dotted_lines": lambda m: m["n_dotted_lines"] * 100 > m["n_lines"] * 30,
    "filler": lambda m: m["n_fillers"] > 0,
}

#: The rules whose failure ``base_failed`` reports.
BASE_RULES = ("few_words", "repeated_words")


class _Inline(Mapping):
    """Every measure, each as an expression over the text; the columns ``ready`` are read instead."""

    def __init__(self, text: Column, ready: Iterable[str] = ()):
        self.text, self.ready = text, set(ready)

    def __getitem__(self, name: str) -> Column:
        return F.col(name) if name in self.ready else MEASURES[name](self.text)

    def __iter__(self):
        return iter(MEASURES)

    def __len__(self) -> int:
        return len(MEASURES)


@dataclass(frozen=True)
class RuleEstimate:
    """What the sample says about a rule: seconds a document, and its place in the cascade."""

    name: str
    seconds: float
    rejects: int
    rejects_in_place: int


def _conditions(text_col: str, ready: Iterable[str], rules: Mapping[str, Callable[[Measures], Column]]) -> dict[str, Column]:
    measures = _Inline(F.coalesce(F.col(text_col).cast("string"), F.lit("")), ready)
    return {name: rule(measures) for name, rule in rules.items()}


def _seconds(sample: DataFrame, condition: Column, repeats: int = 2) -> float:
    """The least time of ``repeats`` runs that judge all of ``sample`` by ``condition``."""
    out = sample.select(condition.alias("hit"))
    times = []
    for _ in range(repeats):
        began = time.perf_counter()
        out.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - began)
    return min(times)


def by_rejection_per_cost(seconds: Mapping[str, float], patterns: Mapping[frozenset[str], int]) -> list[RuleEstimate]:
    """The rules in the order of the cascade.

    ``patterns``: how many documents of the sample each set of rules rejects (with the empty set).  Ties go to
    the cheaper rule, then to the smaller name.
    """
    left, alive, out = dict(seconds), dict(patterns), []
    total = {r: sum(n for p, n in patterns.items() if r in p) for r in seconds}
    while left:
        hits = {r: sum(n for p, n in alive.items() if r in p) for r in left}
        best = min(left, key=lambda r: (-hits[r] / max(left[r], 1e-9), left[r], r))
        out.append(RuleEstimate(best, left.pop(best), total[best], hits[best]))
        alive = {p: n for p, n in alive.items() if best not in p}
    return out


def estimate(docs: DataFrame, rules: Mapping[str, Callable[[Measures], Column]] = RULES, text_col: str = "text", ready: Iterable[str] = (),
             sample_rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> list[RuleEstimate]:
    """Cost and selectivity of ``rules`` on a sample of ``docs``, in the order of the cascade.

    Every document has the same chance, whatever its place; the draw takes one pass over the texts.
    ``sample_rows`` bounds what it expects to draw.  The measures ``ready`` are taken of the sample before, so
    they cost the rules nothing.  The marks come to the driver counted by pattern, at most one number a
    sampled document.
    """
    ready = tuple(ready)
    drawn = docs.select(text_col)
    count = docs.count()
    if count > sample_rows:
        drawn = drawn.sample(sample_rows / count, seed=seed)
    sample = saved(measure(drawn, text_col, ready), "rules-sample")
    conditions = _conditions(text_col, ready, rules)
    names = list(conditions)
    marks = F.array(*conditions.values())
    patterns = {
        frozenset(n for n, hit in zip(names, row["marks"], strict=True) if hit): row["n"]
        for row in sample.select(marks.alias("marks")).groupBy("marks").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not patterns:
        return [RuleEstimate(n, 0.0, 0, 0) for n in names]
    rows = sum(patterns.values())
    idle = _seconds(sample, F.col(text_col).isNull())
    seconds = {n: max(_seconds(sample, c) - idle, 1e-6) / rows for n, c in conditions.items()}
    return by_rejection_per_cost(seconds, patterns)


def measure(docs: DataFrame, text_col: str = "text", names: Iterable[str] = BASE) -> DataFrame:
    """``docs`` with the measures ``names`` (long) of every whole text."""
    names = tuple(names)
    measures = _Inline(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return without(docs, names).withColumns({n: measures[n] for n in names})


def cascade(docs: DataFrame, order: Iterable[str], rules: Mapping[str, Callable[[Measures], Column]] = RULES, text_col: str = "text",
            ready: Iterable[str] = (), kept_col: str = "kept", rejected_col: str = "rejected_by") -> DataFrame:
    """``docs`` with ``rejected_col``, the first rule in ``order`` that rejects (NULL: none), and ``kept_col``."""
    conditions = _conditions(text_col, ready, rules)
    first = F.lit(None).cast("string")
    for name in reversed(list(order)):
        first = F.when(conditions[name], F.lit(name)).otherwise(first)
    judged = without(docs, [kept_col, rejected_col]).withColumn(rejected_col, first)
    return judged.withColumn(kept_col, F.col(rejected_col).isNull())


def filter_documents(docs: DataFrame, rules: Mapping[str, Callable[[Measures], Column]] = RULES, text_col: str = "text",
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their own columns only."""
    order = [e.name for e in estimate(docs, rules, text_col, sample_rows=sample_rows)]
    judged = cascade(docs, order, rules, text_col, kept_col="_kept", rejected_col="_rejected_by")
    return judged.filter("_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
