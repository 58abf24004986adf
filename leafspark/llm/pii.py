"""Personal data by candidate spans and boosted trees, in built-in expressions only.

Base detection finds e-mail addresses, IP addresses, card and phone numbers by fixed formats. High-recall
generators then propose further, overlapping spans; each gets features of its format and context, and the
sum of boosted trees, compiled into CASE expressions, is its score. Spans over their kind's threshold are
added where they overlap no base span, the leftmost first. Base spans always stay.

The trees learn from planted items, not from what base detection says: personal data and look-alikes (versions,
dates, amounts, serial numbers, measurements, failing cards) are made by rule, in many spellings and after many
phrases, and set into a bounded, hashed sample of the corpus's own texts. Candidates over a planted item are
positive if they match its place and kind, negative if it is a look-alike. A threshold is the lowest score of its
kind at which, among items kept apart, 95 of 100 candidates are positive.

Everything happens in the row: nothing shuffles. Patterns are possessive and anchored at the start of runs, so
a text's length costs linear time and no recursion, with the same matches as the plain forms. Places of
matches come from running sums of the lengths of matches and gaps, in code points.

Defined cases: a null or empty text has no spans and is returned as it is by ``redacted``; equal texts give equal
spans; texts of any length are read whole; on an empty table only base spans are used; other columns pass through
``redacted`` and are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store
from leafspark.llm.quality_rules import let

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"

#: Base formats. A run starts where no character of it precedes, or where the match before ended.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a format to match at all.
HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Generators of candidates: kind, hint, format.
GENERATORS = (
    ("email", "@", BASE["email"]),
    ("email", "at", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{{1,63}}+(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{{1,63}}+){{1,4}}"),
    ("ip", ".", r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9.])"),
    ("card", "", r"(?<![0-9A-Za-z])[0-9]{12,19}(?![0-9A-Za-z])"),
    ("card", "", r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20-][0-9]{4}){2,3}(?:[\x20-][0-9]{1,3})?(?![0-9A-Za-z])"),
    ("phone", "+", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    ("phone", "", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
KEYWORDS = r"(?i)\b(?:e-?mail|contact|tel|phone|call|fax|mobile|card|visa|credit|payment|ip|host|server|address)\b"
FEATURES = ("generator", "length", "digits", "marks", "luhn", "octets", "plus", "digit_before", "digit_after", "keyword")
CONTEXT = 24
CHUNK = 256


def _running(values: Column) -> Column:
    """Sums of the values before each one; in chunks, so that appending stays cheap."""

    def fold(xs: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<bigint>").alias("a"))
        step = lambda acc, x: F.struct(
            (acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")
        )
        return F.aggregate(xs, zero, step)

    def whole(xs: Column) -> Column:
        n = F.ceil(F.size(xs) / CHUNK).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), n - 1), lambda i: fold(F.slice(xs, i * CHUNK + 1, F.lit(CHUNK))))
        return let(chunks, lambda c: F.flatten(F.zip_with(
            c, fold(F.transform(c, lambda x: x["s"]))["a"], lambda x, before: F.transform(x["a"], lambda v: v + before)
        )))

    return F.when(F.size(values) > 0, let(values, whole)).otherwise(F.array().cast("array<bigint>"))


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """start, end, hit, before and after (text around, up to other matches) of each match of a non-null text."""

    def located(gaps: Column, hits: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: (F.length(g) + F.length(h)).cast("long"))
        return let(_running(sizes), lambda at: F.transform(hits, lambda h, i: let(
            F.get(at, i) + F.length(F.get(gaps, i)),
            lambda start: F.struct(
                start.alias("start"), (start + F.length(h)).alias("end"), h.alias("hit"),
                F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(2)).alias("after"),
            ),
        )))

    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>")
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(
        F.size(hits) > 0, let(F.split(text, pattern, -1), lambda gaps: located(gaps, hits))
    ).otherwise(none))
    return F.when(F.contains(text, F.lit(hint)), found).otherwise(none) if hint else found


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]+", "")


def _octets(hit: Column) -> Column:
    """Whether the four parts are at most 255."""
    part = lambda p: F.coalesce(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int"), F.lit(999)) <= 255
    return F.forall(F.split(hit, r"\."), part)


def _luhn(digits: Column) -> Column:
    return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return _octets(hit)
    if kind == "card":
        return let(_digits(hit), _luhn)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _has_any(text: Column) -> Column:
    return text.rlike(r"[0-9@]") | F.contains(text, F.lit("at)")) | F.contains(text, F.lit("at]"))


SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def base_spans(text: Column) -> Column:
    """Spans (start, kind, end) by start, then kind."""
    t = F.coalesce(text, F.lit(""))

    def of(k: int, kind: str) -> Column:
        kept = F.filter(_matches(t, BASE[kind], HINT[kind]), lambda m: _valid(kind, m["hit"]))
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end")))

    found = [of(k, kind) for k, kind in enumerate(KINDS)]
    return F.when(t.rlike(r"[0-9@]"), F.array_sort(F.concat(*found))).otherwise(F.array().cast(SPANS))


def candidates(text: Column) -> Column:
    """Candidates of all generators: start, kind, end, valid, x (features, in the order of FEATURES)."""
    t = F.coalesce(text, F.lit(""))
    number = lambda c: c.cast("double")

    def of(g: int, kind: str, hint: str, pattern: str) -> Column:
        def made(m: Column) -> Column:
            return let(_digits(m["hit"]), lambda d: F.struct(
                m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
                F.coalesce(_valid(kind, m["hit"]), F.lit(False)).alias("valid"),
                F.array(
                    F.lit(float(g)), number(F.length(m["hit"])), number(F.length(d)),
                    number(F.length(m["hit"]) - F.length(F.regexp_replace(m["hit"], "[^A-Za-z0-9]+", ""))),
                    number(F.coalesce(_luhn(d), F.lit(False))), number(F.coalesce(_octets(m["hit"]), F.lit(False))),
                    number(m["hit"].startswith("+")), number(m["before"].rlike(r"[0-9][\x20.-]?$")),
                    number(m["after"].rlike(r"^[\x20.-]?[0-9]")), number(m["before"].rlike(KEYWORDS)),
                ).alias("x"),
            ))

        return F.transform(_matches(t, pattern, hint), made)

    found = [of(g, *generator) for g, generator in enumerate(GENERATORS)]
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,valid:boolean,x:array<double>>>")
    return F.when(_has_any(t), F.concat(*found)).otherwise(none)


@dataclass
class Tree:
    """A leaf has a value; a split sends x[feature] <= at to the left."""

    value: float = 0.0
    feature: int = -1
    at: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.at, self.left.predict(x), self.right.predict(x))

    def column(self, x: Column) -> Column:
        if self.left is None:
            return F.lit(float(self.value))
        here = F.get(x, F.lit(self.feature)) <= float(self.at)
        return F.when(here, self.left.column(x)).otherwise(self.right.column(x))


@dataclass
class Model:
    trees: list[Tree] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, x: Column) -> Column:
        out = F.lit(0.0)
        for t in self.trees:
            out = out + t.column(x)
        return out

    def accepts(self, c: Column) -> Column:
        limit = F.lit(float("inf"))
        for k, v in self.thresholds.items():
            limit = F.when(c["kind"] == k, float(v)).otherwise(limit)
        return self.score(c["x"]) >= limit


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, shrink: float) -> Tree:
    """Tree of second-order gains; g and h are the loss's first and second derivatives."""
    lam, out = 1.0, Tree(value=float(-shrink * g.sum() / (h.sum() + 1.0)))
    if depth == 0 or len(x) < 4:
        return out
    best, parent = 1e-6, g.sum() ** 2 / (h.sum() + lam)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, gs, hs = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if len(cut):
            gain = gs[cut] ** 2 / (hs[cut] + lam) + (gs[-1] - gs[cut]) ** 2 / (hs[-1] - hs[cut] + lam) - parent
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, out.feature, out.at = float(gain[k]), f, float((v[cut[k]] + v[cut[k] + 1]) / 2)
    if out.feature >= 0:
        go = x[:, out.feature] <= out.at
        out.left = _grow(x[go], g[go], h[go], depth - 1, shrink)
        out.right = _grow(x[~go], g[~go], h[~go], depth - 1, shrink)
    return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 12, depth: int = 3, shrink: float = 0.4) -> list[Tree]:
    trees, f = [], np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        trees.append(_grow(x, p - y, p * (1 - p), depth, shrink))
        f += trees[-1].predict(x)
    return trees


PHRASES = {
    "email": ("mail", "write to", "contact", "e-mail:", "address", "reach me at", "", "from"),
    "ip": ("host", "server", "ip", "login from", "address", ""),
    "card": ("card", "visa", "paid with", "credit card", "order 12", "ref 7", "payment", "", "no 4"),
    "phone": ("call", "tel", "phone", "mobile", "fax", "contact", "ring", "", "or"),
}
OTHER = ("version", "build", "section", "chapter", "part no", "serial", "isbn", "total", "on", "id", "invoice", "sum of", "", "rows", "grid")


def _luhn_digit(digits: list[int]) -> int:
    total = sum(sum(divmod(2 * d, 10)) if k % 2 == 0 else d for k, d in enumerate(reversed(digits)))
    return -total % 10


def planted(items: int, seed: int) -> list[tuple[int, int, str, str]]:
    """(kind, 1 or 0 for a look-alike, phrase before, item), as many of each as make ``items`` in all."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(3, 9)))
    area = lambda: f"{rng.integers(201, 990)}"

    def email() -> str:
        at, dot = pick(("@", " (at) ", " [at] ", "(at)", "[at]")), pick((".", ".", " (dot) ", " [dot] "))
        return f"{name()}{pick(('', '.', '_', '-'))}{name()}{at}{name()}{dot if at != '@' else '.'}{pick(('org', 'com', 'net', 'de'))}"

    def card() -> str:
        body = [4, *map(int, rng.integers(0, 10, 14))]
        d = "".join(map(str, [*body, _luhn_digit(body)]))
        return pick((d, f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}", f"{d[:4]}-{d[4:8]}-{d[8:12]}-{d[12:]}"))

    def phone() -> str:
        a, b, c, sep = area(), digits(3), digits(4), pick((" ", "-", "."))
        return pick((f"({a}) {b}-{c}", f"{a}{sep}{b}{sep}{c}", f"+1 ({a}) {b}-{c}", f"+{rng.integers(20, 99)} {a} {b} {c}"))

    def other_email() -> str:
        return pick((f"{name()} [at] {name()}", f"look (at) {name()} and", f"{name()}(at){digits(2)}", f"{name()} (at) {name()}, {name()}"))

    def other_ip() -> str:
        return pick((f"{digits(1)}.{digits(2)}.{digits(1)}", f"{digits(1)}.{digits(1)}.{digits(3)}.{rng.integers(256, 999)}"))

    def other_card() -> str:
        body = list(map(int, rng.integers(1, 10, 15)))
        wrong = (_luhn_digit(body) + int(rng.integers(1, 10))) % 10
        d = "".join(map(str, [*body, wrong]))
        return pick((d, f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}", f"2024{digits(8)}{wrong}"[:12] + str(wrong), f"{digits(4)}-{digits(4)}-{digits(4)}"))

    def other_phone() -> str:
        return pick((f"{digits(3)} {digits(3)} {digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"{area()}-{digits(3)}-{digits(4)}", f"+{digits(1)}.{digits(3)}.{digits(4)}"))

    made = ((email, other_email), (lambda: ".".join(str(v) for v in rng.integers(0, 256, 4)), other_ip), (card, other_card), (phone, other_phone))
    out = []
    for i in range(items):
        k, good = i % len(KINDS), i // len(KINDS) % 2
        out.append((k, good, pick(PHRASES[KINDS[k]] if good else OTHER), made[k][1 - good]()))
    return out


def fit(
    docs: DataFrame, text: str = "text", sample_rows: int = 10_000, items: int = 2400, precision: float = 0.95, seed: int = 5
) -> Model:
    """Trees and thresholds from ``items`` planted in about ``sample_rows`` texts, and no more than twice that."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("t")).filter("t is not null")
    sample = store.bounded_sample(rows, "t", sample_rows, docs.count())
    plants = spark.createDataFrame([(i, *p) for i, p in enumerate(planted(items, seed))], "i int, k int, y int, phrase string, item string")
    number = F.pmod(F.xxhash64("t", F.lit("plant")), F.lit(items)).cast("int")
    left = F.rtrim(F.regexp_replace(F.substring("t", 1, 160), r"\S*$", ""))
    right = F.regexp_replace(F.substring("t", 161, 160), r"^\S*", "")
    near = sample.select(left.alias("left"), right.alias("right"), number.alias("i")).join(F.broadcast(plants), "i")
    lead = F.concat_ws(" ", F.col("left"), F.when(F.col("phrase") != "", F.col("phrase")), F.lit(""))
    around = near.select("i", "k", "y", lead.alias("lead"), "item", "right")
    start = F.length("lead").cast("long")
    both = around.select(
        "i", "k", "y", start.alias("a"), (start + F.length("item")).alias("z"), candidates(F.concat("lead", "item", "right")).alias("c")
    )
    over = F.filter("c", lambda c: (c["start"] < F.col("z")) & (F.col("a") < c["end"]))
    found = both.select("i", "k", "y", "a", "z", F.explode(over).alias("c"))
    whole = (F.col("c.start") == F.col("a")) & (F.col("c.end") == F.col("z")) & (F.col("c.kind") == F.col("k"))
    told = found.filter(whole | (F.col("y") == 0))  # what meets only a part of an item tells nothing
    got = told.select("i", F.col("c.kind").alias("k"), F.col("c.x").alias("x"), (whole & (F.col("y") == 1)).alias("y")).collect()
    x = np.array([r["x"] for r in got], dtype=float).reshape(-1, len(FEATURES))
    y, kind = np.array([r["y"] for r in got], dtype=float), np.array([r["k"] for r in got])
    if not y.any():
        return Model()
    apart = np.array([r["i"] for r in got]) // (2 * len(KINDS)) % 2 == 1
    out = Model(boost(x[~apart], y[~apart]))
    score = sum((t.predict(x) for t in out.trees), np.zeros(len(y)))
    for k in range(len(KINDS)):
        here = apart & (kind == k)
        s, t = score[here], y[here]
        order = np.argsort(-s, kind="stable")
        good = np.cumsum(t[order]) >= precision * np.arange(1, len(t) + 1)
        last = np.ones(len(t), dtype=bool)
        last[:-1] = s[order][1:] < s[order][:-1]  # a threshold takes all of a score
        if (good & last).any():
            out.thresholds[k] = float(s[order][np.flatnonzero(good & last).max()])
    return out


def added_spans(base: Column, found: Column, model: Model) -> Column:
    """Accepted candidates that overlap no base span, leftmost and then longest first, without overlaps."""
    free = lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    accepted = F.filter(found, lambda c: model.accepts(c) & free(c))
    order = F.array_sort(F.transform(accepted, lambda c: F.struct(
        c["start"].alias("start"), (-c["end"]).alias("neg"), c["kind"].alias("kind"), c["end"].alias("end")
    )))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("a"))
    step = lambda acc, c: F.when(
        c["start"] >= acc["at"],
        F.struct(
            c["end"].alias("at"),
            F.concat(acc["a"], F.array(F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))).alias("a"),
        ),
    ).otherwise(acc)
    return F.aggregate(order, zero, step, lambda acc: acc["a"])


def with_spans(docs: DataFrame, model: Model, text: str, base: str, spans: str) -> DataFrame:
    """docs with the base spans and all spans of each text."""
    t = F.col(text)
    out = docs.withColumn(base, base_spans(t))
    if not model.thresholds:
        return out.withColumn(spans, F.col(base))
    none = F.array().cast(SPANS)
    more = let(candidates(t), lambda c: F.when(F.size(c) > 0, added_spans(F.col(base), c, model)).otherwise(none))
    return out.withColumn(spans, F.when(_has_any(F.coalesce(t, F.lit(""))), F.array_sort(F.concat(F.col(base), more))).otherwise(none))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def detected(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = 10_000) -> DataFrame:
    """doc_id, base and spans of every row of docs."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("t"))
    return with_spans(rows, fit(rows, "t", sample_rows), "t", "base", "spans").select("doc_id", "base", "spans")


def redacted(docs: DataFrame, text: str = "text", sample_rows: int = 10_000) -> DataFrame:
    """docs with every span replaced by its kind in brackets; touching and overlapping spans become one."""
    model = fit(docs, text, sample_rows)
    boxed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{text}`"].alias("t"))
    found = with_spans(boxed, model, "t", "base", "spans")
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def rewritten(t: Column, spans: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(t, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
            new = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.get(name, s["kind"]))).alias("out"))
            inside = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
            return F.when((s["start"] >= acc["at"]), new).otherwise(inside)

        rest = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(t, (a["at"] + 1).cast("int"), F.length(t)))
        return F.aggregate(spans, zero, step, rest)

    new = F.when(F.size("spans") > 0, rewritten(F.col("t"), F.col("spans"))).otherwise(F.col("t"))
    return found.select("row", new.alias("t")).select(
        *[F.col("t").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
