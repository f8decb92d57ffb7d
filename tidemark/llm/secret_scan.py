"""Secret scan with an incremental ledger of content-addressed texts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import light, stored

#: A text's share of all rows, and count, from which its findings are broadcast: at most 1000 texts.
HOT_SHARE, HOT_ROWS = 1000, 10_000


@dataclass(frozen=True)
class Rule:
    """``group`` of a match has ``least`` characters; a change of any of these asks for a new ``version``."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules.
BASE = (
    Rule("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                   r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: Rules beyond those: key blocks, signed web tokens, logins in addresses, service tokens.
RULES = BASE + (
    Rule("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+-----END [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("login", r"://[^\x00-\x20/?#:@]+:[^\x00-\x20/?#@]+@"),
    Rule("service", r"(gh[pousr]_|xox[abprs]-)([A-Za-z0-9-]+)", 2, 20),
)
SPAN = "struct<rule:string,start:long,end:long>"


def quick(pattern: str, least: int) -> re.Pattern:
    """A final greedy run of a class, ungrouped, is matched only at its least length: the same findings, fewer matches."""
    run = re.fullmatch(r"([A-Z]*)(\[[^\]]+\])\+", pattern)
    if run and least > len(run[1]) + 1:
        pattern = f"{run[1]}{run[2]}{{{least - len(run[1])},}}"
    return re.compile(pattern, re.A)


def finder(rules: list[Rule]):
    """text -> spans (rule, start, end) in code points, leftmost and non-overlapping for each rule."""
    ready = [(r.name, r.group, r.least, quick(r.pattern, r.least) if not r.group else re.compile(r.pattern, re.A)) for r in rules]

    def find(text: str, wanted: set[str]) -> list[tuple]:
        return [(name, m.start(), m.end()) for name, group, least, pattern in ready if name in wanted
                for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]

    return find


class Ledger:
    """Parquet folder in which every scanned pair of text and rule version is entered.

    Each append is a folder of its own; one without its success mark (a run that
    was lost) is not read. Columns: ``blob`` (SHA-256 of the text, 32 bytes), ``rules`` (names with versions that
    it was scanned for) and ``findings``.
    """

    SCHEMA = f"blob binary, rules array<string>, findings array<{SPAN}>"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def folders(self) -> list[str]:
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/run-*/_SUCCESS")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(str(s.getPath().getParent()) for s in fs.globStatus(root) or [])

    def read(self) -> DataFrame:
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*folders)

    def append(self, scanned: DataFrame) -> None:
        scanned.write.option("compression", "zstd").parquet(f"{self.path}/run-{uuid.uuid4().hex}")


def unseen(blobs: DataFrame, ledger: Ledger, names: list[str]) -> DataFrame:
    """``blob``, ``todo`` of the ``blobs`` not yet scanned for all rules called ``names``."""
    known = ledger.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    todo = F.array_except(F.array(*[F.lit(n) for n in names]), F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.select("blob").distinct().join(known, "blob", "left").select("blob", todo.alias("todo")).where(F.size("todo") > 0)


def scan_texts(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Ledger rows of ``texts`` (``blob``, ``text``, ``todo``)."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = finder(rules)
        for batch in batches:
            spans = [[{"rule": r, "start": a, "end": b} for r, a, b in find(text, set(todo))]
                     for text, todo in zip(batch["text"], batch["todo"])]
            yield pd.DataFrame({"blob": batch["blob"], "rules": batch["todo"], "findings": spans})

    return texts.mapInPandas(scan, Ledger.SCHEMA)


def with_findings(paths: DataFrame, found: DataFrame) -> DataFrame:
    """``paths`` with the ``found`` rows of their blob; a text that many paths have is joined by broadcast."""
    wide = light(found)
    if wide is not found:
        return paths.join(wide, "blob", "left")
    n = paths.count()
    hot = paths.groupBy("blob").count().where(F.col("count") > max(HOT_ROWS, n // HOT_SHARE)).select("blob")
    hot = F.broadcast(stored(hot, "hot-blobs"))
    some = paths.join(F.broadcast(stored(found.join(hot, "blob", "left_semi"), "hot-findings")), "blob", "left").join(hot, "blob", "left_semi")
    return some.unionByName(paths.join(hot, "blob", "left_anti").join(found, "blob", "left"))


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``versions`` (all but the text), one row for each path and historical version,
    with ``blob`` (SHA-256 of the text, hex) and ``findings``, an array of ``kind``, ``start``, ``end`` (code points,
    end exclusive) ordered by start, then kind as in ``rules``.

    A text is scanned once, wherever and however often it stands, and only for rule versions that
    the ledger has not entered for it; what is scanned is entered. Findings of other versions of a rule
    do not count. Defined cases: null text counts as empty, an empty one has no findings; texts of
    any length are scanned whole; equal rows have equal findings, each; an empty table has none; extra
    columns are kept, one called ``blob`` or ``findings`` is replaced.
    """
    names = [r.name for r in rules]
    keep = [c for c in keep or versions.columns if c.lower() not in (text_col.lower(), "blob", "findings")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    address = F.unhex(F.sha2(text, 256))
    paths = stored(versions.select(F.struct(*keep).alias("row"), address.alias("blob")), "paths")
    first = F.first("text").alias("text")
    every = versions.select(address.alias("blob"), text.alias("text"))
    if ledger.folders():
        todo = stored(unseen(paths, ledger, names), "unseen")
        near = light(todo)
        if near is not todo:  # few: no other text is moved
            texts = every.join(near, "blob").groupBy("blob", "todo").agg(first)
        else:
            texts = every.groupBy("blob").agg(first).join(todo, "blob")
    else:
        texts = every.groupBy("blob").agg(first).withColumn("todo", F.array(*[F.lit(n) for n in names]))
    ledger.append(scan_texts(texts.select("blob", "text", "todo"), list(rules)))
    spans = ledger.read().where(F.size("findings") > 0).select("blob", F.explode("findings").alias("f")).where(F.col("f.rule").isin(names))
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("f.rule"))
    found = spans.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
        F.col("f.start"), rank.alias("rank"), F.col("f.end"), F.substring_index("f.rule", "@", 1).alias("kind")))).alias("spans"))
    out = with_findings(paths, stored(found, "findings"))
    plain = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return out.select("row.*", F.lower(F.hex("blob")).alias("blob"), F.coalesce(plain, none).alias("findings"))


def digest(findings: Column) -> Column:
    """``kind:start:end`` of the findings, joined by commas."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
