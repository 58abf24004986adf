"""Quality rules as a short-circuit cascade, in built-in expressions only.

A rule is a condition that rejects a text. Rules are evaluated inside one CASE, whose branches stop at the
first rejection, so a dear rule runs only on what the cheap ones left. The order is learned: on a bounded
hashed sample each rule's cost (CPU seconds a row, of its tasks alone) and selectivity (share rejected) are
measured, and rules are sorted by rejections per second. The order changes the time, never the verdict.
A figure that is wanted for every row anyway costs its rule nothing more; rules read it instead of the text.

Nothing shuffles: every figure of a text is computed where the text is read.

Defined cases: a null or empty text, or one of white space only, has no words and fails ``few_words``;
copies get equal verdicts; texts of any length are read whole; an empty table gives an empty result; other columns pass through, and helper
columns are never added beside them, so names cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row, also where body uses it in a nested lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of characters outside the six ASCII spaces; null gives none."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACES)),
    )


def word_count(text: Column) -> Column:
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE)),
        lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACES))),
    ).cast("long")


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")).cast("long")


def symbol_count(text: Column, symbols: str = SYMBOLS) -> Column:
    others = "[^" + "".join("\\" + c for c in symbols) + "]+"
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), others, "")).cast("long")


def worded_lines(text: Column) -> Column:
    """Lines split at \\n that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")


def _copies(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def duplicate_lines(text: Column) -> Column:
    return let(worded_lines(text), _copies)


def _covered(at: Column, width: int) -> Column:
    """Positions covered by windows of the width that start at the sorted positions."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        at,
        zero,
        lambda a, p: F.struct((a["n"] + p + width - F.greatest(p, a["end"])).alias("n"), (p + width).alias("end")),
        lambda a: a["n"],
    )


def repeated_words(text: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the text, the first included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. Only a text whose hashes are not
    all distinct is sorted, so the common case costs one hash set a text.
    """

    def windows(h: Column) -> Column:
        each = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])
        return F.when(
            F.size(h) >= width, F.transform(F.sequence(F.lit(0), F.size(h) - width), each)
        ).otherwise(F.array().cast("array<bigint>"))

    def marked(t: Column) -> Column:
        pairs = F.array_sort(F.transform(t, lambda x, i: F.struct(x.alias("t"), i.alias("i"))))
        twice = lambda s: F.filter(
            s, lambda e, j: (F.get(s, j - 1)["t"] == e["t"]) | (F.get(s, j + 1)["t"] == e["t"])
        )
        at = let(pairs, twice)
        return _covered(F.array_sort(F.transform(at, lambda e: e["i"])), width)

    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(
        let(hashes, windows),
        lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(marked(t)),
    ).cast("long")


def figures(text: Column) -> dict[str, Column]:
    return {
        "n_words": word_count(text),
        "word_chars": word_chars(text),
        "n_symbols": symbol_count(text),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(text),
    }


Figure = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """rejects: of a text and its figures by name, true where the text goes."""

    name: str
    rejects: Callable[[Column, Figure], Column]


MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def _duplicates(text: Column, figure: Figure) -> Column:
    return let(worded_lines(text), lambda x: 100 * _copies(x) > 30 * F.size(x))


RULES = (
    Rule("few_words", lambda t, f: f("n_words") < MIN_WORDS),
    Rule("repeated_words", lambda t, f: 100 * f("n_repeat_words") > MAX_REPEATED_PERCENT * f("n_words")),
    Rule("symbols", lambda t, f: 10 * f("n_symbols") > f("n_words")),
    Rule("duplicate_lines", _duplicates),
    Rule("word_length", lambda t, f: let(f("word_chars"), lambda c: (c < 2 * f("n_words")) | (c > 20 * f("n_words")))),
    Rule("shouting", lambda t, f: 5 * symbol_count(t, "!") > f("n_words")),
)


def figure(text: Column, known: dict[str, Column]) -> Figure:
    """Figures by name: those that are known, and the others from the text where a rule asks for them."""
    return lambda name: known[name] if name in known else figures(text)[name]


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        """Rejections a second; rules that reject nothing go by cost alone."""
        return (self.rejected + 1e-6) / max(self.seconds, 1e-9)


def _cpu(df: DataFrame) -> tuple[int, float]:
    """The only number of a one-row table, and the CPU seconds of the tasks that made it."""
    sc, group = df.sparkSession.sparkContext, f"leafspark-{uuid.uuid4().hex}"
    before = sc.getLocalProperty("spark.jobGroup.id")
    sc.setLocalProperty("spark.jobGroup.id", group)
    try:
        n = df.collect()[0][0]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", before)
    context = sc._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    tracker, used = sc.statusTracker(), 0
    for job in tracker.getJobIdsForGroup(group):
        for stage in tracker.getJobInfo(job).stageIds:
            used += context.statusStore().lastStageAttempt(stage).executorCpuTime()
    return n, used / 1e9


def measure(
    docs: DataFrame, text: str, rules: tuple[Rule, ...], sample_rows: int, known: tuple[str, ...] = ("n_words",)
) -> list[Measured]:
    """Cost and selectivity of each rule on about ``sample_rows`` rows, by worth, the best first.

    ``known`` names the figures that are ready when a rule runs. The cost of reading the sample is taken off.
    """
    spark = docs.sparkSession
    with store.scratch(spark):
        rows = docs.select(F.col(text).alias("t"))
        rows = store.bounded_sample(rows, "t", sample_rows, docs.count())
        made = figures(F.col("t"))
        sample = store.cut(rows.select("t", *[made[k].alias(k) for k in known]), "sample")
        n = max(sample.count(), 1)
        f = figure(F.col("t"), {k: F.col(k) for k in known})

        def cost(rejects: Column) -> tuple[int, float]:
            def run() -> tuple[int, float]:  # a new plan each time: Spark would reuse what the old one shuffled
                return _cpu(sample.select(F.count_if(rejects), F.count_if(F.length("t") < 0), *[F.max(k) for k in known]))

            run()  # compiles
            return min((run() for _ in range(2)), key=lambda x: x[1])

        _, reading = cost(F.lit(False))
        out = []
        for rule in rules:
            hits, seconds = cost(F.coalesce(rule.rejects(F.col("t"), f), F.lit(True)))
            out.append(Measured(rule, max(seconds - reading, 0.0) / n, hits / n))
    return sorted(out, key=lambda m: -m.worth)


def verdict(text: Column, ordered: list[Rule], known: dict[str, Column] | None = None) -> Column:
    """Name of the first rule that rejects, null where none does; words are counted once for all rules."""

    def first(ready: dict[str, Column]) -> Column:
        f, out = figure(text, ready), F.lit(None).cast("string")
        for rule in reversed(ordered):
            out = F.when(F.coalesce(rule.rejects(text, f), F.lit(True)), F.lit(rule.name)).otherwise(out)
        return out

    return first(known) if known else let(word_count(text), lambda n: first({"n_words": n}))


def cascade(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000
) -> DataFrame:
    """The rows that no rule rejects, with the columns of docs."""
    ordered = [m.rule for m in measure(docs, text, rules, sample_rows)]
    return docs.filter(verdict(F.col(text), ordered).isNull())


def judged(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = 1000,
) -> DataFrame:
    """Each row's key, figures, base_failed, the first rule that rejects it, and whether the cascade keeps it.

    The five figures are wanted for every row, so they are ready when the cascade begins. What else a rule needs of
    the text is read inside its branch, only where no rule before it rejects.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ordered = [m.rule for m in measure(docs, text, rules, sample_rows, names)]
    out = docs.select(
        F.col(key).alias("doc_id"),
        F.col(text).alias("t"),
        F.struct(*[figures(F.col(text))[k].alias(k) for k in names]).alias("f"),
    )
    f = {k: F.col(f"f.{k}") for k in names}
    base = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEATED_PERCENT * f["n_words"])
    out = out.select(
        "doc_id", *[f[k].alias(k) for k in names], base.alias("base_failed"), verdict(F.col("t"), ordered, f).alias("rejected_by")
    )
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
