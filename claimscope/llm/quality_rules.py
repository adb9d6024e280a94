"""Quality rules: a ledger of failure bits and measurements, policies over it, ablations.

Every rule is evaluated once for each document. The ledger stores one bit for each failed rule
beside the measurements that the rules read. A policy is a version and a mask of the rules that
it applies, so a new policy, a comparison of policies and an ablation are bitwise arithmetic over
the ledger: no text is read again.

Defined results: a null text is measured as an empty one (no words, so ``few_words`` fails);
an empty table gives an empty ledger; repeated rows get equal rows; input columns whose names
clash with the ledger's are replaced by the ledger's. Texts are measured whole, very long ones one at
a time; a measure equal to a rule's threshold passes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import compress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.llm.common import tune

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_alpha_words", "n_letters", "n_upper")
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` (SQL over the measurements) is true; ``bit`` is its place."""

    bit: int
    name: str
    fails: str


#: Bits are never given to another rule: stored ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule(3, "symbols", "10 * n_symbols > n_words"),
    Rule(4, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(5, "few_alphabetic_words", "10 * n_alpha_words < 6 * n_words"),
    Rule(6, "shouting", "2 * n_upper > n_letters"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
POLICIES = (BASE, Policy("strict-1", tuple(r.name for r in RULES)), Policy("no-case-1", tuple(r.name for r in RULES if r.name != "shouting")))
DEFAULT = POLICIES[1]

_UPPER = bytes(range(65, 91))
_ALPHA = _UPPER + bytes(range(97, 123))


def measure(raw: bytes) -> tuple[int, ...]:
    """The values of MEASURES for one UTF-8 text. bytes.split() splits at exactly the contract's blanks."""
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(MEASURES)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            end = -1
            for i in compress(range(n), [seen[w] > 1 for w in windows]):
                repeated += i + 3 - max(i, end)
                end = i + 3
    text = raw.decode("utf-8", "replace")
    ascii_letters = len(raw) - len(raw.translate(None, _ALPHA))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    wide = text.encode("ascii", "ignore")
    if len(wide) < len(raw):
        other = [c for c in text if c > "\x7f"]
        ascii_letters += sum(c.isalpha() for c in other)
        upper += sum(c.isupper() for c in other)
    alpha = sum(not w.translate(None, _ALPHA) == w or not w.isascii() for w in words)
    return n, len(b"".join(words).decode("utf-8", "replace")), len(raw) - len(raw.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated, alpha, ascii_letters, upper


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(x or b"") for x in batch.column(batch.num_columns - 1).to_pylist()]
        columns = list(zip(*rows)) if rows else [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in columns)], names=[*batch.schema.names[:-1], *MEASURES])


def ledger(df: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all other columns), the measurements and ``fail_bits`` (long) of each row."""
    tune(df.sparkSession)
    made = {*MEASURES, "fail_bits", "base_failed", "kept", "policy"}
    keep = [c for c in (df.columns if keep is None else keep) if c not in made and c != text]
    narrow = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("__raw"))
    schema = T.StructType([*narrow.schema.fields[:-1], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    measured = narrow.mapInArrow(_measured, schema)
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES), F.lit(0)).cast("long")
    return measured.withColumn("fail_bits", bits)


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def store(ledger_df: DataFrame, path: str) -> DataFrame:
    """Writes a ledger and reads it back; policies that come later are applied to it by apply_policy()."""
    ledger_df.write.mode("overwrite").parquet(path)
    return ledger_df.sparkSession.read.parquet(path)


def apply_policy(ledger_df: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """A ledger with ``base_failed``, ``kept`` (not base_failed, and ``policy`` passes) and the policy's version."""
    return ledger_df.withColumns({"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(policy), "policy": F.lit(policy.version)})


def compare(ledger_df: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """For each policy: version, mask, n_docs, n_kept, any_bits and all_bits (OR and AND of the failures it sees)."""
    each = F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(p.mask).cast("long").alias("mask")) for p in policies])
    seen = ledger_df.select("fail_bits", F.explode(each).alias("p")).select("p.version", "p.mask", F.expr("fail_bits & p.mask").alias("hit"))
    return seen.groupBy("version", "mask").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("hit") == 0).alias("n_kept"), F.bit_or("hit").alias("any_bits"), F.bit_and("hit").alias("all_bits"))


def ablation(ledger_df: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """For each rule of ``policy``: n_failed, and n_rescued (documents that only this rule removes)."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    counts = ledger_df.groupBy(hit.alias("hit")).agg(F.count(F.lit(1)).alias("n"))  # at most 2^rules rows
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if r.name in policy.rules])
    return counts.select("hit", "n", F.explode(rules).alias("r")).groupBy("r.rule").agg(F.coalesce(F.sum(F.expr("if(hit & r.bit != 0, n, 0)")), F.lit(0)).alias("n_failed"), F.coalesce(F.sum(F.expr("if(hit = r.bit, n, 0)")), F.lit(0)).alias("n_rescued"))


def judge(df: DataFrame, policy: Policy = DEFAULT, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The ledger of ``df`` under ``policy``."""
    return apply_policy(ledger(df, text, keep), policy)
