"""Personal data: base expressions, and contextual patterns bootstrapped from what they find. DataFrame functions only.

Seed entities (matches of the base expressions) are tied to the lexical patterns they occur in: the word before or the
word after together with the entity's class (number, dotted number, address), and the entity's own form. Candidates are
runs of number-like words and addresses, also spelled-out ones, that no base match touches. Rounds of scoring over the
bipartite graph of patterns and instances follow: a pattern's confidence is the belief in its instances over their
number, an instance's belief the noisy-or of its confident patterns. Instances whose belief passes the threshold are
personal data wherever they occur, and seeds of the next round: a word can so teach a new form, and a form a new word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, join_spread, lower_ascii, table

KINDS = ("email", "ip", "card", "phone")
# The base expressions, written so that a failing start costs no backtracking over a long run.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_NUMBER = r"(?<![A-Za-z0-9@._%+()-])[+(]?[0-9](?:[0-9()._+-]*[0-9)])?(?![A-Za-z0-9@%])"
_ADDRESS = rf"(?<!{_LOCAL}){_LOCAL}++(?:@|\x20?[\[(](?i:at)[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?)[A-Za-z0-9-]++)*+"
#: What an unseen identifier is made of: an address, or up to RUN number-like words a blank apart with so many digits.
CANDIDATE = f"{_ADDRESS}|{_NUMBER}"
RUN, LEAST_DIGITS, MOST_DIGITS = 4, 7, 19
#: A pattern needs this many believed instances, and instances and patterns this confidence.
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.8, 3
#: Matches that are laid out one after the other before blocks of them are.
BLOCK = 256
_FOUND = "array<struct<v:string,l:int,glue:boolean,left:string,right:string>>"
_SPAN = "array<struct<s:int,e:int,v:string,glue:boolean,left:string,right:string>>"


def _none(kind: str) -> Column:
    return F.expr(f"CAST(array() AS {kind})")


def _word_before(gap: Column) -> Column:
    return lower_ascii(F.reverse(F.regexp_extract(F.reverse(gap), r"^\s*(\S+)", 1)))


def _word_after(gap: Column) -> Column:
    return lower_ascii(F.regexp_extract(gap, r"^\s*(\S+)", 1))


def _cut_at(text: Column, pattern: str) -> Column:
    """The matches, the texts between them, and whether there are any; both null where there is none."""
    return F.when(text.rlike(pattern), F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g")))


def _found(c: Column) -> Column:
    """Each match with the length of the text before it and the words beside it."""
    before = F.zip_with(c["m"], F.slice(c["g"], 1, F.size(c["m"])), lambda m, g: F.struct(m.alias("v"), F.length(g).alias("l"), (g == " ").alias("glue"), _word_before(g).alias("left")))
    both = F.zip_with(before, F.slice(c["g"], 2, F.size(c["m"])), lambda x, g: F.struct(x["v"].alias("v"), x["l"].alias("l"), x["glue"].alias("glue"), x["left"].alias("left"), _word_after(g).alias("right")))
    return F.coalesce(both, _none(_FOUND))


def _blocks(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), ((F.size(items) - 1) / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))).otherwise(F.array())


def _spans(found: Column) -> Column:
    """Starts and ends (code points, end exclusive) of the matches. They are added up in blocks, and the blocks then laid out,
    so that a text with many matches doesn't copy the list of all for each."""
    zero = F.struct(F.lit(0).alias("at"), _none(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["l"]
        end = start + F.length(x["v"])
        one = F.struct(start.alias("s"), end.alias("e"), x["v"].alias("v"), x["glue"].alias("glue"), x["left"].alias("left"), x["right"].alias("right"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    own = F.transform(_blocks(found), lambda b: F.aggregate(b, zero, step))
    laid = F.aggregate(
        own, F.struct(F.lit(0).alias("at"), _none(f"array<{_SPAN}>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(F.transform(x["out"], _moved(acc["at"])))).alias("out")),
    )
    return F.flatten(laid["out"])


def _moved(by: Column):
    return lambda y: F.struct((y["s"] + by).alias("s"), (y["e"] + by).alias("e"), y["v"].alias("v"), y["glue"].alias("glue"), y["left"].alias("left"), y["right"].alias("right"))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return (acc + F.when(i % 2 == 0, twice).otherwise(d)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.translate(v, " -", "")
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(v, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _passes(kind: str):
    return lambda x: _valid(kind, x["v"])


def _is(k: int):
    return lambda x: x["k"] == k


def _form(v: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(v, r"\p{L}+", "a"), "[0-9]", "9")


def _class(v: Column) -> Column:
    return F.when(v.rlike("@|[a-z]"), "address").when(v.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), "dotted").otherwise("number")


_SEEN = "array<struct<k:int,s:int,e:int,v:string,left:string,right:string>>"


def _seen(k: int | None):
    return lambda x: F.struct(F.lit(k).cast("int").alias("k"), x["s"].alias("s"), x["e"].alias("e"), lower_ascii(x["v"]).alias("v"), x["left"].alias("left"), x["right"].alias("right"))


def _runs(words: Column) -> Column:
    """Runs of up to ``RUN`` neighbouring number-like words with few or many enough digits, and addresses."""

    def at(x: Column, i: Column) -> Column:
        out, value, glued = [], x["v"], F.lit(True)
        for n in range(RUN):
            last = F.get(words, i + n)
            if n:
                value, glued = F.concat_ws(" ", value, last["v"]), glued & F.coalesce(last["glue"], F.lit(False)) & ~last["v"].contains("@")
            digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
            good = glued & (digits.between(LEAST_DIGITS, MOST_DIGITS) & ~x["v"].rlike("@|[A-Za-z]") | (x["v"].rlike("@|[A-Za-z]") if n == 0 else F.lit(False)))
            out.append(F.when(good, F.struct(F.lit(None).cast("int").alias("k"), x["s"].alias("s"), last["e"].alias("e"), lower_ascii(value).alias("v"), F.when(x["glue"] & (i > 0), "").otherwise(x["left"]).alias("left"), last["right"].alias("right"))))
        return F.filter(F.array(*out), lambda c: c.isNotNull())

    return F.flatten(F.transform(words, at))


def _touches(blocks: Column):
    return lambda x: F.exists(blocks, lambda b: (b["lo"] < x["e"]) & (x["s"] < b["hi"]) & F.exists(b["own"], lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, th, base, seen)`` per row: the text's hash, its base spans, and every span (kind null for candidates that
    touch no base span) with its value and neighbouring words. One narrow stage, kept in the shared folder."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    every = [*PATTERNS.items(), ("other", CANDIDATE)]
    df = df.select("id", F.xxhash64("t").alias("th"), *[_cut_at(F.col("t"), p).alias(f"c_{k}") for k, p in every])
    df = df.select("id", "th", *[_found(F.col(f"c_{k}")).alias(f"f_{k}") for k, _ in every])
    df = df.select("id", "th", *[_spans(F.col(f"f_{k}")).alias(f"s_{k}") for k, _ in every])
    kept = F.concat(*[F.transform(F.filter(F.col(f"s_{k}"), _passes(k)), _seen(i)) for i, k in enumerate(KINDS)])
    df = df.select("id", "th", kept.alias("own"), F.when(F.size("s_other") > 0, _runs(F.col("s_other"))).otherwise(_none(_SEEN)).alias("other"))
    by_place = F.array_sort("own", lambda a, b: a["s"] - b["s"])
    df = df.select("id", "th", "own", "other", F.transform(_blocks(by_place), lambda b: F.struct(F.get(b, F.lit(0))["s"].alias("lo"), F.array_max(F.transform(b, lambda x: x["e"])).alias("hi"), b.alias("own"))).alias("blocks"))
    free = F.when(F.size("other") > 0, F.filter("other", lambda x: ~_touches(F.col("blocks"))(x))).otherwise(_none(_SEEN))
    return cut(df.select("id", "th", F.transform("own", lambda b: F.struct(b["k"].alias("k"), b["s"].alias("s"), b["e"].alias("e"))).alias("base"), F.concat("own", free).alias("seen")))


def bootstrap(scanned: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Believed instances ``(v, k, belief, n)`` that have n places outside of base spans (seeds among them), and confident patterns ``(side, word, shape, k, conf, n)``.

    Patterns and instances are aggregated to distinct pairs first, so copies of a text add nothing and a frequent
    pattern or value costs a partial sum. Confidence is belief / (instances + 1).
    """
    rows = scanned.select(F.explode("seen").alias("x")).select("x.k", "x.v", "x.left", "x.right")
    seen = cut(rows.groupBy("k", "v", "left", "right").agg(F.count("*").alias("n")))
    form = seen.select(F.lit("form").alias("side"), F.lit("").alias("word"), _form(F.col("v")).alias("shape"), "v")
    edges = form
    for side in ("left", "right"):
        edges = edges.unionByName(seen.where(F.col(side) != "").select(F.lit(side).alias("side"), F.col(side).alias("word"), _class(F.col("v")).alias("shape"), "v"))
    edges = cut(edges.distinct())
    number = edges.count()
    seeds = cut(seen.where("k IS NOT NULL").groupBy("v").agg(F.min("k").alias("k")).withColumn("belief", F.lit(1.0)))
    belief, patterns, on = seeds, None, ["side", "word", "shape"]
    size = cut(edges.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") >= support))
    for _ in range(rounds):
        good = edges.join(belief, "v").groupBy(*on, "k").agg(F.sum("belief").alias("b")).where(F.col("b") >= support)
        patterns = cut(good.join(size, on).select(*on, "k", (F.col("b") / (F.col("n") + 1)).alias("conf"), "n").where(F.col("conf") >= confidence))
        scored = join_spread(edges, patterns, on, number).join(seeds.select("v"), "v", "left_anti").groupBy("v", "k").agg((1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("belief"))
        new = scored.where(F.col("belief") >= confidence).groupBy("v").agg(F.max(F.struct("belief", (-F.col("k")).alias("k"))).alias("x")).select("v", (-F.col("x.k")).alias("k"), "x.belief")
        new = cut(new)
        belief = seeds.unionByName(new)
    places = seen.where("k IS NULL").groupBy("v").agg(F.sum("n").alias("n"))
    return belief.join(places, "v"), patterns


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, th, base, spans)`` per row: arrays of (k, s, e), k counting ``KINDS``, in order of kind, then start.

    Base spans follow the expressions leftmost and without overlap in each kind; matches that fail a kind's test go
    without another try. Of discovered spans that overlap the longer one counts, then the earlier one. Null texts count as
    empty and give empty arrays; repeated rows give equal results; a null id is kept; extra columns play no part; an
    empty table gives an empty one.
    """
    scanned = scan(docs, id_col, text_col)
    new = cut(bootstrap(scanned)[0])
    places = scanned.select("id", "th", F.explode(F.filter("seen", lambda x: x["k"].isNull())).alias("x")).select("id", "th", "x.v", "x.s", "x.e")
    at = join_spread(places, new, ["v"], new.agg(F.sum("n")).first()[0] or 0)
    more = at.groupBy("id", "th").agg(F.collect_set(F.struct("k", "s", "e")).alias("more")).select(F.col("id").alias("more_id"), F.col("th").alias("more_th"), "more")

    def best(x: Column) -> Column:
        longer = lambda y: (y["e"] - y["s"] > x["e"] - x["s"]) | ((y["e"] - y["s"] == x["e"] - x["s"]) & (y["s"] < x["s"]))
        return ~F.exists("more", lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]) & longer(y))

    more = more.select("more_id", "more_th", F.filter("more", best).alias("more"))
    joined = scanned.join(more, F.col("id").eqNullSafe(F.col("more_id")) & (F.col("th") == F.col("more_th")), "left")
    kind = scanned.schema["base"].dataType.simpleString()
    return joined.select("id", "th", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", F.coalesce("more", _none(kind)))).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole of ``documents``; the counts are of base spans, ``spans`` holds all."""
    found = find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets and ``n_chars`` counted anew; columns as they were.

    Of overlapping spans the one that starts first (then the longer) is replaced. Rows without spans are untouched.
    """
    found = find(docs).where(F.size("spans") > 0).groupBy(F.col("id").alias("pii_id__"), F.col("th").alias("pii_th__")).agg(F.first("spans").alias("pii_spans__"))
    by = F.array_sort(F.transform("pii_spans__", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["k"].alias("k"))))
    zero = F.struct(F.lit(0).alias("at"), _none("array<struct<s:int,e:int,k:int>>").alias("out"))
    pick = F.aggregate(by, zero, lambda acc, x: F.when(x["s"] < acc["at"], acc).otherwise(F.struct((-x["e"]).cast("int").alias("at"), F.concat(acc["out"], F.array(F.struct(x["s"].alias("s"), (-x["e"]).cast("int").alias("e"), x["k"].alias("k")))).alias("out"))))["out"]
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    df = docs.join(found, F.col("doc_id").eqNullSafe(F.col("pii_id__")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("pii_th__")), "left").withColumn("pii_pick__", pick)
    picks, text = F.col("pii_pick__"), F.col("text")
    parts = F.transform(picks, lambda x, i: F.concat(F.substring(text, F.when(i > 0, F.get(picks, i - 1)["e"]).otherwise(0) + 1, x["s"] - F.when(i > 0, F.get(picks, i - 1)["e"]).otherwise(0)), F.get(names, x["k"])))
    rest = F.substring(text, F.element_at(picks, -1)["e"] + 1, F.length(text))
    clean = F.when(F.col("pii_spans__").isNotNull(), F.concat(F.array_join(parts, ""), rest)).otherwise(text)
    out = df.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("pii_spans__").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
