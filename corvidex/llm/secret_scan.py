"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every distinct text is a *blob*, addressed by its SHA-256.  The ledger holds one
row for each blob with the rules and versions that scanned it, findings or none,
so a later run scans only pairs that the ledger lacks; findings are then joined back
to every row (path) that carries the blob.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class SecretRule:
    kind: str
    pattern: str  #: Java regular expression; matches are leftmost and don't overlap
    group: int  #: the group whose length counts
    least: int  #: code points of that group
    hint: str  #: SQL over ``text``: false only if nothing can match
    base: bool = True
    sql: str | None = None  #: the same for engines without look-ahead and possessive repeats
    version: int = 1  #: goes up with every change of the rule

    @property
    def tag(self) -> str:
        return f"{self.kind}:{self.version}"


#: Rules in the order in which kinds are listed.
RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, r"""text RLIKE '(?i)(password|passwd|secret|token|api_?key)[\\x22\\x27]?\\x20*[:=]'"""),
    # A run of fewer characters is no match at all, as no later start in it can have more.
    SecretRule("access", r"(AKIA[A-Z0-9]{16,})", 1, 20, "contains(text, 'AKIA')"),
    SecretRule("hex", r"([0-9a-f]{24,})", 1, 24, "text RLIKE '[0-9a-f]{24}'"),
    SecretRule("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*)", 1, 20, "contains(text, 'eyJ')", False),
    # Through the end line; without one, through the lines of base64 that follow. A possessive repeat of a group takes no stack, however long the key.
    SecretRule(
        "private_key", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----|(?:[\t-\r ]+[A-Za-z0-9+/=]{32,}+)*+(?:[\t-\r ]+[A-Za-z0-9+/]+={1,2})?))", 1, 20, "contains(text, '-----BEGIN ')", False,
        r"(-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-----END [A-Z ]*PRIVATE KEY-----|(?:[\t-\r ]+[A-Za-z0-9+/=]{32,})*(?:[\t-\r ]+[A-Za-z0-9+/]+={1,2})?))", 3,
    ),
    SecretRule("forge", r"(gh[opsur]_[A-Za-z0-9]{30,})", 1, 34, "contains(text, 'gh')", False),
    SecretRule("url_login", r"([a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{3,128}@)", 1, 8, "contains(text, '://')", False),
)

#: A row for each blob and each run that scanned it: the rules with their versions that were applied, and what they found.
LEDGER = "blob string, scanned array<string>, findings array<struct<start:long,kind_no:int,end:long,kind:string>>"


def blob(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda x: F.length(x))


def scan(blobs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Ledger rows for ``blobs(blob, text)``, one per row; with a column ``known`` of tags, these rules aren't applied again.

    Spark's functions give matches without places. A place is the length of
    all pieces and matches before it, so each kind yields the lengths of the
    matches and of the pieces between, and a running sum within the blob does
    the rest; texts aren't shuffled for it.
    """
    some = "known" in blobs.columns
    unseen = lambda r: ~F.array_contains("known", r.tag) if some else F.lit(True)
    tags = F.array(*(F.lit(r.tag) for r in rules))
    scanned = (F.array_except(tags, F.col("known")) if some else tags).alias("scanned")
    kinds = []
    for no, r in enumerate(rules):
        p = F.lit(r.pattern)
        full = _lengths(F.regexp_extract_all("text", p, F.lit(0)))
        part = _lengths(F.regexp_extract_all("text", p, F.lit(r.group)))
        rest = _lengths(F.split("text", r.pattern, -1))
        lengths = F.when(F.expr(r.hint) & unseen(r), F.arrays_zip(full.alias("n"), part.alias("part"), F.slice(rest, F.lit(1), F.greatest(F.size(rest) - 1, F.lit(0))).alias("gap")))
        kinds.append(F.struct(F.lit(no).alias("kind_no"), lengths.alias("found")))
    # One small row per blob, without its text, holds all lengths: the regular expressions run once.
    measured = common.materialize(blobs.select("blob", scanned, F.filter(F.array(*kinds), lambda k: F.size(k["found"]) > 0).alias("kinds")), "secret-lengths")
    each = measured.select("blob", F.inline("kinds")).select("blob", "kind_no", F.posexplode("found").alias("pos", "m"))
    before = Window.partitionBy("blob", "kind_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.n") + F.col("m.gap")).over(before)
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("kind_no") + 1)
    name = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind_no") + 1)
    spans = each.withColumn("end", end.cast("long")).where(F.col("m.part") >= least)
    found = spans.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("m.n")).cast("long").alias("start"), F.col("kind_no"), F.col("end"), name.alias("kind")))).alias("findings"))
    none = F.array().cast("array<struct<start:long,kind_no:int,end:long,kind:string>>")
    return measured.select("blob", "scanned").join(found, "blob", "left").select("blob", "scanned", F.coalesce("findings", none).alias("findings"))


def update(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """The ledger rows that ``docs`` adds to ``ledger``: unseen pairs of a blob and a rule's version, the latter in ``scanned``.

    Null texts count as empty. Copies and repeated rows share a blob, which is
    scanned once. Texts are scanned whole, however long.
    """
    texts = docs.select(blob().alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).dropDuplicates(["blob"])
    if ledger is None:
        return scan(texts, rules)
    tags = F.array(*(F.lit(r.tag) for r in rules))
    known = ledger.select("blob", F.explode(F.array_intersect("scanned", tags)).alias("tag")).groupBy("blob").agg(F.collect_set("tag").alias("known"))
    left = texts.join(known, "blob", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    return scan(left.where(F.size(F.array_except(tags, F.col("known"))) > 0), rules)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that is kept at ``path``; empty if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def append(docs: DataFrame, path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` lacks of ``docs``, append it, and give the whole ledger.

    Files are added by Spark's committer. Runs at once may both add a pair; it is
    the same row twice, and counts once.
    """
    spark = docs.sparkSession
    fresh = common.materialize(update(docs, read_ledger(spark, path), rules), "secret-ledger")
    fresh.write.mode("append").option("compression", "zstd").parquet(path)
    return read_ledger(spark, path)


def _book(docs: DataFrame, ledger: DataFrame | None, rules: tuple[SecretRule, ...]) -> DataFrame:
    """``blob, findings`` of the blobs of ``docs`` and ``ledger`` in which the rules, as they are now, find something; one row each."""
    fresh = common.materialize(update(docs, ledger, rules), "secret-ledger")
    if ledger is None:
        return fresh.where(F.size("findings") > 0).select("blob", "findings")
    # A finding counts if its rule has the version that was applied; its number is the rule's of now.
    now = F.create_map(*(F.lit(x) for no, r in enumerate(rules) for x in (r.kind, F.struct(F.lit(no).alias("no"), F.lit(r.tag).alias("tag")))))
    each = fresh.unionByName(ledger.select(*fresh.columns)).where(F.size("findings") > 0)
    valid = F.filter("findings", lambda f: F.coalesce(F.array_contains("scanned", now[f["kind"]]["tag"]), F.lit(False)))
    told = F.transform(valid, lambda f: F.struct(f["start"].alias("start"), now[f["kind"]]["no"].alias("kind_no"), f["end"].alias("end"), f["kind"].alias("kind")))
    return each.select("blob", told.alias("findings")).groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("findings")))).alias("findings")).where(F.size("findings") > 0)


def find(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``doc_id, blob, findings`` for every row of ``docs``; findings are ordered by start, then kind.

    Repeated rows come back as often, a null number too, and rows of one number
    have the findings of their own texts. Other columns aren't read.
    """
    none = F.array().cast("array<struct<start:long,kind_no:int,end:long,kind:string>>")
    return docs.select("doc_id", blob().alias("blob")).join(_book(docs, ledger, rules), "blob", "left").select("doc_id", "blob", F.coalesce("findings", none).alias("findings"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """The contract's columns."""
    base = [no for no, r in enumerate(rules) if r.base]
    count = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(rules[no].kind) for no in base),
        F.sha2(_joined(F.filter("findings", lambda s: s["kind_no"].isin(base))).cast("binary"), 256).alias("base_sha256"), _joined(F.col("findings")).alias("spans"),
    )


def redact(docs: DataFrame, ledger: DataFrame | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding replaced by ``mark``; ``n_chars`` follows where ``docs`` has it. Other columns stay.

    Overlapping spans are merged first. Rows without a finding are unchanged.
    """
    own_blob, own_from, own_to = (f"__{uuid.uuid4().hex}" for _ in range(3))  # no columns of ``docs``
    empty = F.array().cast("array<struct<start:long,end:long>>")
    span = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    # The last merged span is held apart, so that the array only grows.
    merged = F.aggregate(
        "findings", F.struct(empty.alias("done"), F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end")),
        lambda acc, s: F.when(s["start"] <= acc["end"], F.struct(acc["done"].alias("done"), acc["start"].alias("start"), F.greatest(acc["end"], s["end"]).alias("end"))).otherwise(
            F.struct(F.when(acc["start"] >= 0, F.concat(acc["done"], F.array(span(acc["start"], acc["end"])))).otherwise(acc["done"]).alias("done"), s["start"].alias("start"), s["end"].alias("end"))),
        lambda acc: F.concat(acc["done"], F.array(span(acc["start"], acc["end"]))),
    )
    hits = _book(docs, ledger, RULES).select(F.col("blob").alias(own_blob), merged.alias("spans"))
    # What stays: from the end of a span to the start of the next. Written first, so that the stage with the texts only cuts.
    none = F.lit(None).cast("long")
    bounds = hits.select(own_blob, F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end")).alias(own_from), F.concat(F.col("spans.start"), F.array(none)).alias(own_to))
    bounds = common.materialize(bounds, "secret-bounds")
    pieces = F.zip_with(own_from, own_to, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), F.coalesce(b - a, F.lit(2147483647).cast("long")).cast("int")))
    found = F.col(own_from).isNotNull()
    joined = docs.withColumn(own_blob, blob()).join(bounds, own_blob, "left").withColumn("text", F.when(found, F.array_join(pieces, mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(found, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)
