"""Quality rules kept as a bitmask ledger.

Every document is measured once and every rule evaluated once; the ledger stores
the measurements and one failure bit a rule. Policies are named masks over those
bits, so a new policy or an ablation reads the ledger and never the texts.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Defined results: null text has no words
and all counts 0; equal rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_arrow, released, text_batches, texts_of, written

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Rule:
    """A named failure: the bit it sets and the condition over the measurements, in whole numbers."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 25 * n_words"),
    Rule("duplicate_lines", 3, "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 16 * n_words"),
    Rule("capitals", 6, "100 * n_capitals > 40 * word_chars"),
    # a heading or a licence line that comes twice is no boilerplate: four repeats at least
    Rule("many_duplicate_lines", 7, "n_dup_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
)
#: Rules of each policy version. "base" is what every later version includes; a version is never changed.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words", "capitals"),
    "v2": ("few_words", "repeated_windows", "symbols", "many_duplicate_lines", "short_words", "long_words", "capitals"),
}
LATEST = "v2"


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    codes = ids[:n]
    size = len(number)
    for k in range(1, window):
        if size > 1 << 31:  # keep codes within 64 bits, whatever the text's length
            codes = np.unique(codes, return_inverse=True)[1]
            size = int(codes.max()) + 1
        codes = codes * len(number) + ids[k : k + n]
        size *= len(number)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    found = np.zeros(n, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + n] |= found
    return int(covered.sum())


def measure_text(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    blanks = sum(map(raw.count, (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")))
    capitals = int(np.count_nonzero((np.frombuffer(raw, np.uint8) - 65) < 26))
    return (
        len(words),
        len(text) - blanks,
        sum(raw.count(bytes([s])) for s in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        capitals,
    )


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the seven measurements as long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            got = np.array([measure_text(t) for t in texts], np.int64).reshape(len(texts), len(MEASURES))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[:, k]) for k in range(len(MEASURES)))], names=["doc_id", *MEASURES])

    return texts_of(df, id_col, text_col).mapInArrow(released(run), "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def failures_of(rules: tuple[Rule, ...] = RULES) -> Column:
    """The failure bits of measured rows."""
    mask: Column = F.lit(0)
    for r in rules:
        mask = mask.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)))
    return mask.cast("long")


def ledger(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``failures``: bit k is set if the rule with bit k fails."""
    return measure(df, id_col, text_col).withColumn("failures", failures_of(rules))


def stored_ledger(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger written to the shared folder and read again: policies and ablations over it never see a text."""
    return written(ledger(df, rules, id_col, text_col), "ledger")


def accept(df: DataFrame, policy: str = LATEST, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, that pass a policy version."""
    bound_arrow(df.sparkSession)
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            got = np.array([measure_text(t) for t in texts], np.int64).reshape(len(texts), len(MEASURES))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[:, k]) for k in range(len(MEASURES)))], names=["row", *MEASURES])

    measured = rows.mapInArrow(released(run), T.StructType([T.StructField("row", df.schema), *(T.StructField(m, T.LongType()) for m in MEASURES)]))
    return measured.withColumn("failures", failures_of(rules)).filter(kept_by(policy)).select("row.*")


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    """The bits of the named rules."""
    known = {r.name: r.bit for r in rules}
    return sum(1 << known[n] for n in dict.fromkeys(names))


def kept_by(policy: str, failures: str = "failures") -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col(failures).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policy: str = LATEST, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(rule, failed, failed_alone, kept_without): what each rule of a policy does, from the ledger alone.

    One count per distinct mask, then bit tests over at most 2 ** rules rows.
    """
    mask = mask_of(POLICIES[policy], rules)
    counts = ledger_rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("m")).agg(F.count("*").alias("n"))
    named = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if r.name in POLICIES[policy]]
    each = counts.select("m", "n", F.explode(F.array(*named)).alias("r")).select("m", "n", "r.rule", "r.bit")
    alone, without = F.col("m") == F.col("bit"), F.col("m").bitwiseAND(F.bitwise_not("bit")) == 0
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return each.groupBy("rule").agg(total(F.col("m").bitwiseAND(F.col("bit")) != 0).alias("failed"), total(alone).alias("failed_alone"), total(without).alias("kept_without"))
