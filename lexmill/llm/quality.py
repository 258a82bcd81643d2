"""Quality rules as a bitmask ledger: rules run once, policies and ablations read the bits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lexmill.llm.common import columns, map_rows, text_or_empty

#: Insults that count as toxic words.
TOXIC_WORDS = (
    "clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless",
)
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

MEASURES = columns(
    n_words="long", word_chars="long", n_symbols="long", n_lines="long", n_dup_lines="long",
    n_repeat_words="long", n_distinct_words="long", n_upper_words="long", n_toxic_words="long",
)


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements; its place in the rule list is its bit."""

    name: str
    fails: str


#: The list only grows: a bit keeps its meaning in every stored ledger. Bounds do not tighten with length: new words
#: come with about the root of the words (the bound falls from 10,000 words on), and insults count per 1,000 words.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars > 20 * n_words"),
    Rule("few_distinct_words", "n_words >= 50 and 20 * n_distinct_words < n_words and n_distinct_words * n_distinct_words < 25 * n_words"),
    Rule("upper_case", "n_words >= 20 and 2 * n_upper_words > n_words"),
    Rule("toxic", "n_toxic_words >= 3 and 1000 * n_toxic_words > n_words or 50 * n_toxic_words > n_words"),
)
BASE_RULES = ("too_few_words", "repeated_windows")
#: Versioned policies: the rules that reject. ``None`` means all.
POLICIES: dict[str, tuple[str, ...] | None] = {"base": BASE_RULES, "v1": None}


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice; windows are compared exactly.

    Windows of 2, 4, 8, ... words are numbered by the pairs of their halves, so equal numbers mean
    equal words. Other window lengths join two overlapping powers of two.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code, width = ids.astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        pair = code[:-step] * (int(code.max()) + 1) + code[step:]
        width += step
        if width < window:
            code = np.unique(pair, return_inverse=True)[1]
        else:
            code = pair
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    mark = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + window, -1)
    return int((np.cumsum(mark[:-1]) > 0).sum())


def measure(text: str, toxic: frozenset[bytes]) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes: splits at the six ASCII white-space characters only
    lines = [line for line in data.split(b"\n") if line.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    joined = b"".join(words)
    # A UTF-8 sequence has one byte that does not continue another.
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    counts = np.bincount(ids, minlength=len(number))
    upper = bad = 0
    for w, k in number.items():
        if w.isupper() and len(w) > 2:
            upper += int(counts[k])
        elif len(w) < 24 and w.strip(b".,!?;:'\"()*#$%&|<>-").lower() in toxic:
            bad += int(counts[k])
    return (
        len(words), chars, sum(map(data.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))),
        len(lines), len(lines) - len(set(lines)), repeated_words(ids), len(number), upper, bad,
    )


def failure_bits(rules: Sequence[Rule] = RULES) -> Column:
    return F.expr(" | ".join(f"if({r.fails}, {1 << k}L, 0L)" for k, r in enumerate(rules))).cast("bigint")


def mask_of(names: Sequence[str] | None, rules: Sequence[Rule] = RULES) -> int:
    """The bits of the named rules; all rules for ``None``."""
    known = [r.name for r in rules]
    if missing := set(names or ()) - set(known):
        raise ValueError(f"unknown rules: {sorted(missing)}")
    return sum(1 << k for k, name in enumerate(known) if names is None or name in names)


def rule_ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rules: Sequence[Rule] = RULES, toxic_words: Sequence[str] = TOXIC_WORDS,
) -> DataFrame:
    """One row per input row: ``id_col``, all measurements, and ``failure_bits``.

    Every rule is evaluated once, whatever policy is applied later. Words are runs of characters
    other than the six ASCII white-space characters. A null text has no words. Ids may be null or
    repeated. Whole texts are measured; other columns are not read.
    """
    toxic = frozenset(w.lower().encode() for w in toxic_words)
    source = docs.select(F.col(id_col).alias("row_id"), text_or_empty(text_col).alias("body"))
    schema = StructType([source.schema["row_id"], *MEASURES.fields])

    def make():
        def apply(ids, texts):
            measured = zip(*(measure(t, toxic) for t in texts))
            return {"row_id": ids} | dict(zip(MEASURES.fieldNames(), measured))

        return apply

    measured = map_rows(source, schema, make).withColumn("failure_bits", failure_bits(rules))
    return measured.withColumnRenamed("row_id", id_col)


def apply_policy(ledger: DataFrame, version: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``policy``, ``base_failed``, ``rejected_by`` (bits of the policy) and ``kept``."""
    bits = F.col("failure_bits")
    base, mask = mask_of(BASE_RULES, rules), mask_of(POLICIES[version], rules)
    return ledger.select(
        "*",
        F.lit(version).alias("policy"),
        (bits.bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
        bits.bitwiseAND(F.lit(mask)).alias("rejected_by"),
        (bits.bitwiseAND(F.lit(base | mask)) == 0).alias("kept"),
    )


def keep_documents(docs: DataFrame, version: str, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns; texts are measured as in the ledger."""
    toxic = frozenset(w.encode() for w in TOXIC_WORDS)

    @F.pandas_udf(MEASURES)
    def measures(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t or "", toxic) for t in texts], columns=MEASURES.fieldNames())

    inner = docs.select(F.struct("*").alias("__row"), measures(F.col(text_col).cast("string")).alias("__m"))
    judged = inner.select("__row", "__m.*").withColumn("failure_bits", failure_bits(rules))
    return apply_policy(judged, version, rules).where("kept").select("__row.*")


def patterns(ledger: DataFrame, version: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``bits, n, back_without``: rows by the rules of a policy that they fail, and the rule that alone rejects them, else 0.

    There are at most two to the number of rules patterns. No rows give no rows.
    """
    bits = F.col("failure_bits").bitwiseAND(F.lit(mask_of(POLICIES[version], rules)))
    counted = ledger.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    single = F.bit_count("bits") == 1
    return counted.withColumn("back_without", F.when(single, F.col("bits")).otherwise(F.lit(0)).cast("bigint"))


def ablations(ledger: DataFrame, version: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per rule of a policy: ``rule, failed, only_here, kept_without, always_with``.

    ``failed`` rows fail the rule, ``only_here`` fail no other rule of the policy (the rows that
    dropping the rule would bring back), ``kept_without`` stay under the policy without the rule,
    and ``always_with`` are the rules that every row failing this one fails too, as bits. Rows are
    first counted by their bits, of which there are at most two to the number of rules.
    """
    mask = mask_of(POLICIES[version], rules)
    by_bits = patterns(ledger, version, rules)
    used = [(r.name, 1 << k) for k, r in enumerate(rules) if mask >> k & 1]
    per_rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for n, b in used]))
    rows = by_bits.select("bits", "n", per_rule.alias("r")).select("bits", "n", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    return rows.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("only_here"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(0)).alias("kept_without"),
        F.bit_and(F.when(fails, F.col("bits"))).alias("always_with"),
    )
