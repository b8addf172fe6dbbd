"""Personal data by candidate spans and boosted trees.

Native: DataFrame functions and MLlib's JVM trees only.

1. Generators propose spans that may overlap: the four base patterns, a loose
   run of digits and separators, and e-mail addresses with ``at`` and ``dot``
   spelt out.  A text is cut by a pattern once; lengths of the cuts give the
   offsets (by running sums over narrow rows), their ends the context.
2. A base match that passes its check (parts, Luhn, digits) is always redacted.
3. Boosted trees, fitted on at most ``SAMPLE`` proposals and on the proposals
   of ``SEEDS`` generated texts, learn from format and context which proposals
   look like such data: base spans, and proposals that pass the wide check of
   their kind (``_wide``).  What decides that check is held back from them: the
   marks of a base match (``@`` and its spelling, ``+``), check digits and an
   issuer's digits, the range of an address's numbers, an ending in letters,
   the order of a phone's groups.  Thresholds per kind are calibrated on all
   proposals that are no base spans, overlap none and have a hit that was not
   fitted on: the lowest score at which ``LEAST`` or more keep the precision
   ``PRECISION``.  A kind without such a score goes by the score above all its
   false proposals, ``DEFAULT`` at least.  Proposals at or above their
   threshold are added, earlier ones first.

Patterns use possessive repeats and anchors at run starts, so the time is
linear in the text and the matches are those of the plain patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floe.llm.common import free_name, sieved, stored

KINDS = ("email", "ip", "card", "phone")
_BYTE = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_WORD = "[A-Za-z0-9._%+-]"
# Base patterns (fixed values), anchored where a plain search could first match.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_WORD})){_WORD}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9A-Za-z])[(]?[0-9](?:[\x20().-]{0,2}[0-9])++",
    "spelt": rf"(?:\G|(?<!{_WORD})){_WORD}++\x20?(?:\[at\]|\(at\)|\{{at\}})\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\[dot\]|\(dot\)|\{{dot\}})\x20?[A-Za-z0-9-]++)++",
}
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "number": r"[0-9]", "spelt": r"[\[({]at[\])}]"}
#: Proposals fitted on at most, and the precision thresholds are set for.
SAMPLE, PRECISION = 20_000, 0.95
#: Bins of the score for the thresholds, the proposals a threshold has to rest on, and the score that serves below.
BINS, LEAST, DEFAULT = 1_000, 20, 0.8
#: Generated texts that are fitted on as well, so that there always are examples of every kind and label.
SEEDS = 2_000
CONTEXT = 24


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _passes(kind: Column, hit: Column) -> Column:
    """The base check of a match of the kind's own pattern."""
    d = _digits(hit)
    n = F.length(d)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", hit.rlike(rf"^0*{_BYTE}(?:\.0*{_BYTE}){{3}}$"))
        .when(kind == "card", n.between(16, 19) & F.expr("luhn_check(regexp_replace(hit, '[^0-9]', ''))"))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(F.lit(False))
    )


_AT = r"\x20?(?:\[at\]|\(at\)|\{at\})\x20?"
_DOT = r"\x20?(?:\.|\[dot\]|\(dot\)|\{dot\})\x20?"
#: Groups of a phone number: three, three and four digits after a country's, or a trunk zero with its area and the rest.
_PHONES = (
    r"^(?:(?:00)?[0-9]{1,3}[\x20.-]{1,2})?(?:\([0-9]{3}\)[\x20.-]{0,2}|[0-9]{3}[\x20.-]{1,2})[0-9]{3}[\x20.-]{1,2}[0-9]{4}$"
    r"|^\(?0[1-9][0-9]{1,3}\)?[\x20.-]{1,2}[0-9](?:[\x20.-]{0,2}[0-9]){5,8}$"
)
_DATE = r"^(?:[0-9]{4}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{4})$"
_CALLED = r"(?i)\b(?:tel|phone|call|mobil|fax|cell)[a-z]*\W{0,3}(?:(?:me|us|at|on|is|no|nr|number)\W{1,3}){0,3}$"


def _plain(hit: Column) -> Column:
    """A hit without the marks by which a base pattern finds it: spelt signs as signs, no leading plus."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(hit, _AT, "@"), _DOT, "."), r"^\+", "")


def _wide(spans: DataFrame) -> Column:
    """Whether a proposal is such data by more than the base patterns accept.

    An address whose last part is letters, once its signs are put back; an IP
    address; a card of 13 to 19 digits by Luhn and an issuer's first digits; a
    phone number by its groups, or by its digits after a word that names one.
    """
    hit, kind, d = F.col("hit"), F.col("kind"), _digits(F.col("hit"))
    n = F.length(d)
    named = n.between(7, 15) & F.col("before").rlike(_CALLED) & ~hit.rlike(_DATE)
    return F.coalesce(
        F.when(kind == "email", _plain(hit).rlike(rf"^{_WORD}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}$"))
        .when(kind == "ip", hit.rlike(rf"^0*{_BYTE}(?:\.0*{_BYTE}){{3}}$"))
        .when(kind == "card", n.between(13, 19) & d.rlike("^(?:[3-6]|2[2-7])") & F.expr("luhn_check(regexp_replace(hit, '[^0-9]', ''))"))
        .when(kind == "phone", (n.between(7, 15) & hit.rlike(_PHONES)) | named),
        F.lit(False),
    )


def proposals(rows: DataFrame) -> DataFrame:
    """``(_row, _doc, text)`` -> all proposed spans, and one row of generator null per text.

    Written once: _row, _doc, generator, kind, start, stop (code points, stop
    exclusive), hit, before, after, base.
    """
    d = rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    for g, p in PATTERNS.items():
        some = F.col("text").rlike(GATES[g])
        d = d.withColumn(f"hit_{g}", F.when(some, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")))
        d = d.withColumn(f"cut_{g}", F.when(F.size(f"hit_{g}") > 0, F.split("text", p, -1)).otherwise(F.array().cast("array<string>")))

    def found(g: str) -> Column:
        def one(hit: Column, i: Column) -> Column:
            gap, then = F.get(F.col(f"cut_{g}"), i), F.get(F.col(f"cut_{g}"), i + 1)
            return F.struct(
                F.lit(g).alias("generator"),
                i.alias("i"),
                hit.alias("hit"),
                F.length(gap).alias("gap"),
                F.right(gap, F.lit(CONTEXT)).alias("before"),
                F.left(then, F.lit(CONTEXT)).alias("after"),
            )

        return F.transform(f"hit_{g}", one)

    empty = "named_struct('generator', cast(null as string), 'i', 0, 'hit', '', 'gap', 0, 'before', '', 'after', '')"
    spans = d.select("_row", "_doc", F.inline(F.concat(F.array(F.expr(empty)), *[found(g) for g in PATTERNS])))
    spans = stored(spans, "pii-hits")
    inside = Window.partitionBy("_row", "generator").orderBy("i")
    size = F.length("hit")
    stop = F.sum(F.col("gap") + size).over(inside.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    spans = spans.withColumn("stop", stop).withColumn("start", F.col("stop") - size)
    # A loose run is read as the kind it looks most like.
    n, dots = F.length(_digits(F.col("hit"))), F.length(F.regexp_replace("hit", r"[^.]", ""))
    loose = F.when((dots == 3) & (F.length("hit") == n + 3), "ip").when(n.between(13, 19), "card").otherwise("phone")
    kind = F.when(F.col("generator") == "spelt", "email").when(F.col("generator") == "number", loose).otherwise(F.col("generator"))
    return spans.withColumn("kind", kind).withColumn("base", F.coalesce(_passes(F.col("generator"), F.col("hit")), F.lit(False))).drop("gap", "i")


FEATURES = (
    "length digits dots dashes spaces parens distinct_digits groups longest_group "
    "glued_before glued_after after_quote cue_phone cue_card cue_ip cue_mail is_email is_ip is_card is_phone"
).split()


def _features(spans: DataFrame) -> DataFrame:
    hit, before = F.col("hit"), F.col("before")
    plain, d = _plain(hit), _digits(hit)

    def count(cls: str) -> Column:
        return F.length(F.regexp_replace(plain, f"[^{cls}]", ""))

    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    cues = {"phone": "tel|phone|call|mobil|fax|cell", "card": "card|visa|credit|master|amex|pay", "ip": r"\bip\b|host|server|addr|login", "mail": "mail|contact|write|send"}
    values = {
        "length": F.length(plain),
        "digits": F.length(d),
        "dots": count("."),
        "dashes": count("-"),
        "spaces": count(r"\x20"),
        "parens": count("()"),
        "distinct_digits": F.size(F.array_distinct(F.split(d, ""))),
        "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "glued_before": before.rlike(r"[\p{L}0-9_=/.-]$"),
        "glued_after": F.col("after").rlike(r"^[\p{L}0-9_=/-]"),
        "after_quote": before.rlike("[\"'=:]\\s?$"),
        **{f"cue_{k}": before.rlike(f"(?i){v}") for k, v in cues.items()},
        **{f"is_{k}": F.col("kind") == k for k in KINDS},
    }
    return spans.select("*", *[F.coalesce(values[n].cast("double"), F.lit(0.0)).alias(f"f_{n}") for n in FEATURES])


def _clear(spans: DataFrame) -> DataFrame:
    """With ``clear``: the span is no base span and overlaps none."""
    row = Window.partitionBy("_row")
    reach = F.max(F.when(F.col("base"), F.col("stop"))).over(row.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    # Read backwards: a frame that ends at the last row is summed anew for every row.
    then = F.min(F.when(F.col("base"), F.col("start"))).over(row.orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, 0))
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(then, F.col("stop")) >= F.col("stop"))
    return spans.withColumn("clear", ~F.col("base") & free)


def _sample(labelled: DataFrame) -> DataFrame:
    """About ``SAMPLE`` proposals of half 0 at most, as many of each kind, generator and label as there are, up to an equal share."""
    strata = ["kind", "generator", "label"]
    mine = labelled.where("half = 0")
    sizes = mine.groupBy(*strata).agg(F.count("*").alias("n"))
    share = SAMPLE // (len(KINDS) * 4)
    # At most 16 sizes; a share by hash needs no sort of a stratum.
    place = F.pmod(F.xxhash64("_row", "generator", "start"), F.lit(1 << 40)) / F.lit(float(1 << 40)) * F.col("n")
    taken = mine.join(F.broadcast(sizes), strata).withColumn("place", place).where(F.col("place") < share)
    return stored(_features(taken.orderBy("place").limit(SAMPLE)), "pii-sample")


def _limits(scored: DataFrame) -> DataFrame:
    """``(kind, least)``: the threshold of each kind.

    From the proposals of half 1, the lowest score at which ``LEAST`` or more
    keep the precision; if there is none, the score above all false proposals of either half, ``DEFAULT`` at least.
    All proposals count, in ``BINS`` bins of the score: a few thousand rows however many there are.
    """
    at = F.floor(F.col("score") * BINS).cast("int")
    mine = (F.col("half") == 1).cast("long")
    bins = scored.groupBy("kind", at.alias("bin")).agg(F.sum(mine).alias("n"), F.sum(mine * F.col("label")).alias("right"), F.min("label").alias("least_label"))
    down = Window.partitionBy("kind").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    so_far = bins.select("kind", "bin", F.sum("n").over(down).alias("n"), F.sum("right").over(down).alias("right"), "least_label")
    enough = (F.col("n") >= LEAST) & (F.col("right") >= PRECISION * F.col("n")) & (F.col("bin") >= BINS // 2)
    precise = F.min(F.when(enough, F.col("bin"))) / F.lit(float(BINS))
    top_false = F.coalesce(F.max(F.when(F.col("least_label") == 0, F.col("bin"))), F.lit(-1)) + 1
    return so_far.groupBy("kind").agg(F.coalesce(precise, F.greatest(top_false / F.lit(float(BINS)), F.lit(DEFAULT))).alias("least"))


def _seeds(spark: SparkSession) -> DataFrame:
    """``SEEDS`` texts, one number or address each, in the formats the checks know and in some that they refuse."""
    i = F.col("id")

    def digits(k: int, salt: int) -> Column:
        return F.left(F.regexp_replace(F.sha2(F.concat(i.cast("string"), F.lit(f":{salt}")), 512), "[^0-9]", ""), F.lit(k))

    def name(salt: int) -> Column:
        return F.translate(digits(6, salt), "0123456789", "abcdeoruim")

    def number(low: int, high: int, salt: int) -> Column:
        return (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(high - low)) + low).cast("string")

    def luhn(body: Column) -> Column:
        last = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda c: F.call_function("luhn_check", F.concat(body, c.cast("string"))))
        return F.concat(body, F.get(last, 0).cast("string"))

    def grouped(c: Column, sep: str) -> Column:
        return F.regexp_replace(c, "([0-9]{4})(?=[0-9])", f"$1{sep}")

    visa, amex = luhn(F.concat(F.lit("4"), digits(14, 1))), luhn(F.concat(F.lit("37"), digits(12, 2)))
    made = [
        F.concat(name(3), F.lit("."), digits(2, 4), F.lit("@"), name(5), F.lit(".com")),
        F.concat(name(3), F.lit(" [at] "), name(5), F.lit(" [dot] org")),
        F.concat_ws(".", *[number(1, 255, k) for k in range(4)]),
        F.concat_ws(".", number(0, 9, 1), number(0, 30, 2), number(256, 999, 3), number(0, 99, 4)),
        visa, grouped(visa, " "), grouped(visa, "-"), amex,
        # Of numbers that only look like cards, nine in ten fail the check digit.
        digits(16, 6), grouped(digits(16, 6), " "), grouped(digits(16, 6), "-"), digits(15, 6), digits(14, 6),
        F.concat(F.lit("16"), digits(11, 7)),
        F.concat(F.lit("+1 ("), number(200, 999, 8), F.lit(") 555-"), digits(4, 9)),
        F.concat(F.lit("("), number(200, 999, 8), F.lit(") 555-"), digits(4, 9)),
        F.concat(number(200, 999, 8), F.lit("-555-"), digits(4, 9)),
        F.concat(F.lit("phone "), digits(9, 10)), digits(9, 10),
        number(1900, 2031, 11),
        F.concat_ws("-", number(1990, 2031, 11), number(10, 13, 12), number(10, 29, 13)),
    ]
    hit = F.get(F.array(*made), F.pmod(i, F.lit(len(made))).cast("int"))
    text = F.concat(name(14), F.lit(" "), name(15), F.lit(" "), hit, F.lit(" "), name(16))
    return spark.range(SEEDS).select(i.alias("_row"), F.lit(None).cast("long").alias("_doc"), text.alias("text"))


def _labelled(spans: DataFrame, purpose: str) -> DataFrame:
    """Proposals with ``label`` (base span, or the wide check holds), ``half`` and ``clear``."""
    every = spans.where("generator IS NOT NULL")
    every = every.withColumn("label", (F.col("base") | _wide(every)).cast("double")).withColumn("half", F.pmod(F.xxhash64("hit"), F.lit(2)))
    return stored(_clear(every), purpose)


def _chosen(spans: DataFrame) -> DataFrame:
    """Scores and selection of the proposals that are no base spans and overlap none: by the trees' score alone."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    every = _labelled(spans, "pii-labelled")
    seeds = _labelled(proposals(_seeds(spans.sparkSession)), "pii-seeds")
    loose = every.where("clear")
    columns = ["_row", "kind", "start", "stop", "score"]
    fitted = [*[f"f_{n}" for n in FEATURES], "label"]
    sample = _sample(every).select(*fitted).union(_features(seeds).select(*fitted))
    assemble = VectorAssembler(inputCols=fitted[:-1], outputCol="features")
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=20, maxDepth=4, stepSize=0.3, seed=6)
    model = trees.fit(assemble.transform(sample).select("features", "label").coalesce(4))
    p = vector_to_array(F.col("probability"))[1]
    scored = model.transform(assemble.transform(_features(loose))).select(*columns[:-1], p.alias("score"), "label", "half")
    scored = stored(scored, "pii-scores")
    limits = stored(_limits(scored), "pii-thresholds")
    return scored.join(F.broadcast(limits), "kind").where(F.col("score") >= F.col("least")).select(*columns)


def find(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All proposals (with a row of generator null per text), and the redactions: _row, kind, start, stop, base, score."""
    spans = stored(proposals(rows), "pii-proposals")
    base = spans.where("base").select("_row", "kind", "start", "stop", F.lit(True).alias("base"), F.lit(1.0).alias("score"))
    more = _chosen(spans)
    by_start = Window.partitionBy("_row").orderBy("start", F.col("score").desc(), "stop", "kind")
    reach = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    more = more.withColumn("free", F.coalesce(reach, F.lit(0)) <= F.col("start")).where("free")
    return spans, base.union(more.select("_row", "kind", "start", "stop", F.lit(False).alias("base"), "score"))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))


def _joined(spans: Column) -> Column:
    """``kind:start:stop`` of structs (kind's place, start, stop), in that order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(text, ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns, per row of ``docs``; the counts are those of the
    base spans, ``n_added`` those of the trees.

    Null and empty texts have no spans; repeated rows and null ids are rows
    of their own; an empty table gives an empty result; other columns are
    never looked at.
    """
    spans, kept = find(_named(docs, id_col, text_col))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    marked = kept.select("_row", F.lit(None).cast("long").alias("_doc"), "kind", "base", F.struct(place.alias("k"), "start", "stop").alias("s"))
    texts = spans.where("generator IS NULL").select("_row", "_doc", F.lit(None).cast("string"), F.lit(None).cast("boolean"), F.lit(None).cast("struct<k:int,start:bigint,stop:bigint>"))
    per = marked.union(texts).groupBy("_row").agg(
        F.max("_doc").alias("doc_id"),
        *[F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS],
        F.count_if(~F.col("base")).alias("n_added"),
        F.collect_list(F.when(F.col("base"), F.col("s"))).alias("base_spans"),
        F.collect_list("s").alias("all_spans"),
    )
    return per.select("doc_id", *[f"n_{k}" for k in KINDS], "n_added", F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"), _joined(F.col("all_spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets
    (``[email]``; overlapping spans become one, named after the first), all
    other columns as they were."""
    names = docs.columns
    key = free_name("row", names)
    marks = free_name("spans", [*names, key])
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "pii-rows")
    _, kept = find(rows.select(F.col(key).alias("_row"), F.lit(None).cast("long").alias("_doc"), F.col(f"`{text_col}`").alias("text")))
    by_start = Window.partitionBy("_row").orderBy("start", "stop", "kind")
    fresh = F.col("start") >= F.coalesce(F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = kept.withColumn("run", F.sum(fresh.cast("int")).over(by_start)).groupBy("_row", "run")
    runs = runs.agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", "stop", "kind")).alias("kind"))
    lists = runs.groupBy(F.col("_row").alias(key)).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind"))).alias(marks))
    lists = stored(lists, "pii-marks")
    # Only texts that may have a span are dealt; the others stay where they are.
    some, plain = sieved(rows, lists.select(key), key)
    both = some.join(lists, key, "left")
    text, spans = F.col(f"`{text_col}`"), F.col(marks)

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["stop"]).cast("int")
        return F.concat(F.substring(text, begin + 1, s["start"].cast("int") - begin), F.lit("["), s["kind"], F.lit("]"))

    tail = F.substring(text, F.element_at(spans, -1)["stop"].cast("int") + 1, F.length(text))
    clean = F.when(spans.isNull(), text).otherwise(F.concat(F.array_join(F.transform(spans, piece), ""), tail))
    marked = both.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in names])
    return marked.union(plain.select(*[F.col(f"`{c}`") for c in names]))
