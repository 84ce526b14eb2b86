"""Secret scans over content-addressed versions.

Every version of every path is addressed by the SHA-256 of its content.  A
ledger holds the (blob, rule, rule version) triples that were scanned.  A scan
joins the blobs with the ledger, runs each rule on the blobs that have not seen
this version of it, and joins all findings back to every path that holds the
blob.  Copies are therefore scanned once, and a later run scans only new
contents or new rule versions.

Only DataFrame functions run here: the text meets regular expressions in the
JVM, and positions follow from the pieces between matches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, whole_row


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and non-overlapping; matches whose group
    ``group`` has fewer than ``least`` characters are dropped afterwards."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


#: A private key from its header to the END of the same label, or where that is
#: missing to the end of the armour headers and base64 lines (line ends may be
#: escaped).  All repetition but that of the label's words is possessive, and
#: the search for END stops at the next BEGIN, so time is linear.
_PEM = (r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----"
        r"(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1-----"
        r"|(?:(?:[\x20\t\r\n]|\\[rn])*+(?:[A-Za-z][A-Za-z0-9-]*+:\x20[^\r\n\\]*+(?=[\r\n\\])|[A-Za-z0-9+/=]{16,}+))++"
        r"(?:(?:[\x20\t]*+(?:\r?\n|\\[rn]))++[A-Za-z0-9+/=]++(?![^\r\n\\\"',;])){0,2}+"
        r"|)")

#: In the order in which kinds are listed where spans start together.
RULES = (
    Rule("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
                   r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=1, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
    Rule("pem", _PEM, version=2),
)

LEDGER = "blob binary, kind string, version int"
FINDINGS = "blob binary, kind string, version int, start long, `end` long"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return _empty(spark, LEDGER)


def empty_findings(spark: SparkSession) -> DataFrame:
    return _empty(spark, FINDINGS)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    names = [c.split() for c in schema.split(", ")]
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name.strip("`")) for name, kind in names])


def address(content: Column) -> Column:
    """SHA-256 of the content's UTF-8 bytes; null content is empty."""
    return F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256))


def _long_enough(rule: Rule) -> str:
    """The rule's pattern for texts that hold a long match: single-class
    patterns need a run of that length, which is quicker to look for."""
    if rule.group == 0 and rule.least > 1 and rule.pattern.endswith("+"):
        fixed = rule.pattern[:rule.pattern.index("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(fixed)},}}"
    return rule.pattern


def spans(content: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's matches, in code points."""
    text, pattern = content, F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)),
                       lambda m: F.char_length(m) >= rule.least)
    gaps = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(F.transform(gaps, F.char_length).alias("gap"),
                         F.transform(found, F.char_length).alias("size"), kept.alias("kept"))
    zero = F.struct(F.lit(0).cast("long").alias("at"),
                    F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(done: Column, m: Column) -> Column:
        start = done["at"] + m["gap"]
        end = (start + F.coalesce(m["size"], F.lit(0))).cast("long")
        return F.struct(end.alias("at"),
                        F.when(m["kept"], F.array_append(done["spans"], F.struct(start.alias("start"), end.alias("end"))))
                        .otherwise(done["spans"]).alias("spans"))

    positions = F.aggregate(steps, zero, step, lambda done: done["spans"])
    return F.when(content.rlike(_long_enough(rule)), positions)


def scan(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Run on ``blobs`` (blob, content; one row each) the rules that ``ledger``
    does not have for them.  Returns the new findings and the new ledger rows,
    both without what was there before.

    Null and empty content has no findings but is entered as scanned; very long
    content is scanned whole; overlapping finds of one kind go to the leftmost.
    An empty table gives no rows, an empty ledger has seen nothing; of repeated
    blobs every row is scanned.  Other columns are not read."""
    seen = (ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("_seen")))
    known = blobs.join(seen, "blob", "left")
    unseen = {rule.kind: ~F.coalesce(F.array_contains(F.col("_seen"), F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))), F.lit(False)) for rule in rules}
    results = [F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"),
                        F.when(unseen[rule.kind], spans(F.col("content"), rule)).alias("spans"),
                        unseen[rule.kind].alias("scanned")) for rule in rules]
    scanned = cut(known.select("blob", F.filter(F.array(*results), lambda r: r["scanned"]).alias("_r"))
                  .select("blob", F.explode("_r").alias("_r")).select("blob", "_r.kind", "_r.version", "_r.spans"))
    findings = (scanned.select("blob", "kind", "version", F.explode("spans").alias("_s"))
                .select("blob", "kind", "version", F.col("_s.start").alias("start"), F.col("_s.end").alias("end")))
    return findings, scanned.select("blob", "kind", "version")


def scan_versions(versions: DataFrame, ledger: DataFrame, findings: DataFrame,
                  rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan ``versions`` (path, content) with the ledger and findings of
    earlier runs.

    Returns (paths, new findings, new ledger rows).  ``paths`` has one row per
    row of ``versions``: path, blob and ``spans``, an array of (start, kind
    number, kind, end) sorted so, of all findings of the current rule versions
    whether old or new.

    Null content is empty; repeated rows share a blob and each get its findings;
    empty tables give no rows; other columns are not read."""
    rows = versions.select("path", address(F.col("content")).alias("blob"), F.coalesce("content", F.lit("")).alias("content"))
    complete = (ledger.join(_current(ledger.sparkSession, rules), ["kind", "version"])
                .groupBy("blob").agg(F.count_distinct("kind").alias("_n")).filter(F.col("_n") == len(rules)))
    pending = rows.select("blob", "content").join(complete, "blob", "left_anti")
    blobs = pending.groupBy("blob").agg(F.first("content").alias("content"))
    new, scanned = scan(blobs, ledger, rules)
    current = (findings.unionByName(new).join(_current(findings.sparkSession, rules), ["kind", "version"])
               .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans")))
    paths = (rows.select("path", "blob").join(current, "blob", "left")
             .select("path", "blob", F.coalesce("spans", F.array().cast(dict(current.dtypes)["spans"])).alias("spans")))
    return paths, new, scanned


def _current(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """The rules' kinds, versions and order (as many rows as rules)."""
    rows = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                              F.lit(i).alias("rank")) for i, r in enumerate(rules)])
    return F.broadcast(spark.range(1).select(F.inline(rows)))


def merged(spans_column: Column) -> Column:
    """Overlapping and touching spans united: an array of (start, end)."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1),
                         F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return (F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), grown)
                .otherwise(F.array_append(done, F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    return F.aggregate(spans_column, F.array().cast(kind), add)


def redact(text: Column, spans_column: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each united span replaced by ``mask``."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        before = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.struct(s["end"].alias("at"), F.concat(done["out"], before, F.lit(mask)).alias("out"))

    return F.aggregate(merged(spans_column), zero, step, lambda done: F.concat(
        done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text))))


def redact_versions(docs: DataFrame, length: str | None = None, rules: tuple[Rule, ...] = RULES,
                    mask: str = "[SECRET]") -> DataFrame:
    """``docs`` (text and any other columns) with every secret masked; ``length``
    names a column that follows the masked text's length.  Texts without a
    secret and null texts stay as they are, and no row goes."""
    spark = docs.sparkSession
    columns = docs.columns
    content = docs.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("content"))
    new, _ = scan(content.groupBy("blob").agg(F.first("content").alias("content")), empty_ledger(spark), rules)
    found = cut(new.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans")))
    spans_found = found.agg(F.sum(F.size("_spans") + 1)).first()[0] or 0    # an array may be long: its spans are counted
    joined = (docs.select(whole_row(docs).alias("_doc"), address(F.col("text")).alias("blob"))
              .join(broadcast_if_small(found, spans_found), "blob", "left"))
    clean = F.when(F.col("_spans").isNull(), F.col("_doc.text")).otherwise(redact(F.col("_doc.text"), F.col("_spans"), mask))
    out = {"text": clean}
    if length is not None:
        out[length] = F.when(F.col("_spans").isNull(), F.col(f"_doc.{length}")).otherwise(
            F.char_length(clean).cast(docs.schema[length].dataType))
    return joined.select(*[out.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in columns])
