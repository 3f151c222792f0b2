"""Secret scans over versions of files, with a ledger of what was scanned already.

Every version is addressed by the SHA-256 of its text. The ledger holds the pairs of content
and rule version that were scanned, with the spans found. A scan picks the contents whose
pair is not in the ledger, one path for each, reads only those texts, appends to the ledger
and joins the spans back to every path that holds the content. Scanning the same corpus
again, or a corpus with copies, reads no content twice; a new rule version scans anew.

Spans come from built-in functions alone: cutting a text at a rule's matches gives the gaps,
extracting the matches gives the rest, and both together give every offset.

Defined cases: a null text is an empty one; two rows with one path and different texts are
two versions; the same row twice gives its findings twice; offsets are code points, the end is
exclusive; an empty table leaves the ledger as it is. Kinds are ordered as in RULES.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import table
from millrace.session import fresh_dir


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds matches; one stays when ``valid``, searched inside it, is found.

    ``present`` must be found in every text that has a match that stays.
    """

    kind: str
    pattern: str
    valid: str
    present: str


# The patterns of the contract. Letters of the keywords count in either case.
_KEYWORD = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = r"[A-Za-z0-9+/_.=-]"

RULES = (
    # The value ends the match, so the last run of value characters of the match must have 8.
    SecretRule(
        "assign",
        _ASSIGN + _VALUE + "+",
        "^" + _ASSIGN + "(" + _VALUE + "{8,})$",
        _ASSIGN + _VALUE + "{8}",
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", r"^.{16,}$", r"AKIA[A-Z0-9]{12}"),
    SecretRule("hex", r"[0-9a-f]+", r"^.{32,}$", r"[0-9a-f]{32}"),
)
RULES_VERSION = "base-1"
SPAN = "array<struct<start: long, kind_no: int, kind: string, end: long>>"


def _spans(text: Column, rule: SecretRule, kind_no: int) -> Column:
    """Matches of one rule that stay, as structs of start, kind number, kind and end."""
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    # (gap, match) pairs in the order of the text; the last gap has no match.
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("match"))
    walked = F.aggregate(
        pairs,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans")),
        lambda done, pair: F.struct(
            (done["at"] + pair["gap"] + F.coalesce(F.length(pair["match"]), F.lit(0))).cast("long").alias("at"),
            F.when(
                pair["match"].rlike(rule.valid),
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + pair["gap"]).cast("long").alias("start"),
                            F.lit(kind_no).alias("kind_no"),
                            F.lit(rule.kind).alias("kind"),
                            (done["at"] + pair["gap"] + F.length(pair["match"])).cast("long").alias("end"),
                        )
                    ).cast(SPAN),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
    )["spans"]
    return F.when(text.rlike(rule.present), walked).otherwise(F.array().cast(SPAN))


def find_secrets(text: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """All spans of a text by start, then by the order of the rules."""
    return F.array_sort(F.concat(*(_spans(text, rule, n) for n, rule in enumerate(rules))))


class BlobLedger:
    """A Parquet table of (blob, rules_version, spans) in a folder all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = f"blob string, rules_version string, spans {SPAN}"

    def read(self) -> DataFrame:
        """Empty until the first scan has written to the folder."""
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(hadoop_path):
            return self.spark.createDataFrame([], self.schema)
        # A pair that two scans have both written counts once.
        return self.spark.read.schema(self.schema).parquet(self.path).dropDuplicates(["blob", "rules_version"])

    def scan(
        self,
        versions: DataFrame,
        path: str = "path",
        rules: tuple[SecretRule, ...] = RULES,
        rules_version: str = RULES_VERSION,
    ) -> DataFrame:
        """Scan what is new in ``versions`` (path and text); return path, blob, spans per row."""
        text = F.coalesce(F.col("text"), F.lit(""))
        blob = F.sha2(text.cast("binary"), 256)
        held = versions.select(F.col(path).alias("path"), blob.alias("blob"))
        known = self.read().where(F.col("rules_version") == rules_version).select("blob")
        # One path per content: contents that many paths hold are merged before the shuffle.
        unseen = (
            held.groupBy("blob")
            .agg(F.min("path").alias("path"), F.count("path").alias("paths"))
            .join(known, "blob", "left_anti")
        )
        texts = versions.select(F.col(path).alias("path"), blob.alias("blob"), text.alias("text"))
        picked = texts.join(
            unseen.select("path", "blob").withColumnRenamed("path", "at").withColumnRenamed("blob", "of"),
            F.col("path").eqNullSafe(F.col("at")) & (F.col("blob") == F.col("of")),
            "left_semi",
        )
        picked.select("blob", F.lit(rules_version).alias("rules_version"), find_secrets(F.col("text"), rules).alias("spans")).write.mode("append").parquet(self.path)
        now = self.read().where(F.col("rules_version") == rules_version).select("blob", "spans").where(F.size("spans") > 0)
        return held.join(now, "blob", "left").select(
            "path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
        )


def span_list(spans: Column) -> Column:
    """kind:start:end joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    ledger = BlobLedger(spark, ledger_path or fresh_dir(spark, "blob-ledger"))
    found = ledger.scan(docs.select("doc_id", "text"), path="doc_id")
    listed = found.select(F.col("path").alias("doc_id"), "spans", span_list(F.col("spans")).alias("list"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return listed.select(
        "doc_id", *(count(rule.kind) for rule in RULES), F.sha2(F.col("list").cast("binary"), 256).alias("base_sha256"), F.col("list").alias("spans")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def _oracle_kind(number: int, kind: str, pattern: str, valid: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  select doc_id, {number} as kind_no, '{kind}' as kind, m,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as s
  from (select doc_id, gaps, ms, unnest(ms) as m, generate_subscripts(ms, 1) as i
        from (select doc_id, string_split_regex(coalesce(text, ''), '{quoted}') as gaps,
                     regexp_extract_all(coalesce(text, ''), '{quoted}') as ms from documents))
  where {valid}"""


_ORACLE_VALUE = "length(regexp_extract(m, '" + RULES[0].valid.replace("'", "''").replace("{8,}", "+") + "', 1)) >= 8"
ORACLE = (
    "with found as ("
    + " union all ".join(
        (
            _oracle_kind(0, "assign", RULES[0].pattern, _ORACLE_VALUE),
            _oracle_kind(1, "access", RULES[1].pattern, "length(m) >= 16"),
            _oracle_kind(2, "hex", RULES[2].pattern, "length(m) >= 32"),
        )
    )
    + """), listed as (
  select doc_id, count(*) filter (kind_no = 0) as n_assign, count(*) filter (kind_no = 1) as n_access,
         count(*) filter (kind_no = 2) as n_hex,
         string_agg(kind || ':' || s::bigint || ':' || (s + length(m))::bigint, ',' order by s, kind_no) as spans
  from found group by doc_id
)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(spans, '')) as base_sha256,
       coalesce(spans, '') as spans
from documents d left join listed l on d.doc_id = l.doc_id
"""
)
