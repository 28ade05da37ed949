"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger is a table with
one row per blob and rule version that has been scanned, holding the spans found. A scan reads only
blobs for which some rule version is missing from the ledger, runs only those rules, and adds its
rows to the ledger; findings then go back to all paths by content address. A new version of one
rule therefore re-reads the blobs with that rule alone, and a copy of a known file costs a join.

Positions come from native functions: a rule's matches (``regexp_extract_all``) and the text
between them (``split``) have the same regular expression, so running sums of their lengths are the
offsets, in code points.

Defined cases: a null text counts as empty, an empty text has no spans, equal texts have equal
spans, a null path is returned like any other, an empty table gives an empty result. Only the two
named columns are read, so other columns of any name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshelf.llm.stored import stored


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have at least ``least`` characters; the span is the whole match.

    A change of ``pattern``, ``group`` or ``least`` needs a new ``version``.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        group=2,
        least=6,
    ),
    # Runs shorter than asked for never match, which leaves the same spans as dropping them afterwards.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: A private key up to its own END line, or without one to the end of its base64 lines. Possessive loops: no text is too long for them.
_PEM = (
    r"-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----(?:"
    r"(?:(?!-----BEGIN |-----END \1PRIVATE KEY-----)[\x00-\x{10FFFF}])*+-----END \1PRIVATE KEY-----"
    r"|(?:(?:[\s\x22'+>#*,]|\\[nrt])*+(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*+|[A-Za-z0-9+/=]{16,}+))*+"
    r"(?:(?:\s|\\[nrt])++[A-Za-z0-9+/]++={0,2}+(?=[\x20\t]*+(?:[\r\n\x22'\\]|\z)))?+)"
)
MORE_RULES = (
    Rule("pem", _PEM, version=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("login", r"://[^\x09-\x0D\x20/:@]{1,64}:[^\x09-\x0D\x20/:@]{1,64}@"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob binary, rule string, spans array<struct<start:bigint,end:bigint>>"


def address(text: str) -> Column:
    """The content address of a text (null: empty)."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _pieces(rule: Rule) -> Column:
    """What a rule sees of ``text``: one element per match, with the lengths of the gap before it and of the match."""
    matches = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    gaps = F.slice(F.split("text", rule.pattern, -1), F.lit(1), F.size(matches))
    value = matches if rule.group == 0 else F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    found = F.transform(
        F.arrays_zip(gaps.alias("gap"), matches.alias("match"), value.alias("value")),
        lambda x, i: F.struct(
            F.lit(rule.name).alias("rule"),
            i.alias("nth"),
            F.length(x["gap"]).cast("bigint").alias("gap"),
            F.length(x["match"]).cast("bigint").alias("size"),
            (F.length(x["value"]) >= rule.least).alias("holds"),
        ),
    )
    return F.when(F.col("text").rlike(rule.pattern), found)


_PIECE = "array<struct<rule:string,nth:int,gap:bigint,size:bigint,holds:boolean>>"


def unseen(versions: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """(blob, text, todo): each blob for which the ledger lacks a rule version, once, with the rules it lacks."""
    blobs = versions.select(address("text").alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    names = F.array(*(F.lit(r.name) for r in rules))
    if ledger is None:
        return blobs.withColumn("todo", names)
    seen = ledger.where(F.col("rule").isin([r.name for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the blobs and rules of ``unseen``: a row also where nothing was found."""
    pieces = F.concat(
        *(
            F.coalesce(F.when(F.array_contains("todo", r.name), _pieces(r)), F.array().cast(_PIECE))
            for r in rules
        ),
        # One element that is no match stands for "scanned", for each rule.
        F.transform("todo", lambda name: F.struct(
            name.alias("rule"), F.lit(-1).alias("nth"), F.lit(0).cast("bigint").alias("gap"),
            F.lit(0).cast("bigint").alias("size"), F.lit(False).alias("holds"))),
    )
    rows = blobs.select("blob", F.inline(pieces))
    running = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.select("*", F.sum(F.col("gap") + F.col("size")).over(running).alias("end"))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "end")
    return ends.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.when(F.col("holds"), span))).alias("spans"))


def extend_ledger(versions: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """The ledger after scanning ``versions`` (column ``text``): old rows and those of unseen pairs.

    The new rows are written before they are used, so that the scan runs once.
    """
    new = stored(scan_blobs(unseen(versions, rules, ledger), rules), "ledger")
    return new if ledger is None else ledger.select(*new.columns).unionByName(new)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found): per blob with any span its spans as (start, nth rule, end, kind), sorted; other blobs are left out.

    Spans of several rules may overlap. Only the current versions of ``rules`` count.
    """
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)))
    kind = F.create_map(*(F.lit(x) for r in rules for x in (r.name, r.kind)))
    rows = ledger.where(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
    rows = rows.select(
        "blob",
        F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), order[F.col("rule")].alias("nth"), s["end"].alias("end"), kind[F.col("rule")].alias("kind"))).alias("spans"),
    )
    return rows.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("found"))


def scan_versions(versions: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``versions`` (path, text) scanned: (path, blob, found) for every row, and the extended ledger.

    Copies of one blob may be a third of all rows: the join back is an outer join of two shuffled
    inputs, which Spark splits at run time, and carries addresses and spans, no texts.
    """
    ledger = extend_ledger(versions, rules, ledger)
    paths = versions.select("path", address("text").alias("blob"))
    return paths.join(findings(ledger, rules), "blob", "left"), ledger


def redacted(found: Column, text: Column, mark: str = "[secret]") -> Column:
    """``text`` with each span replaced by ``mark``; overlapping spans become one mark."""
    step = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def add(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    return F.when(found.isNull(), text).otherwise(
        F.aggregate(found, step, add, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    )
