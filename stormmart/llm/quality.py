"""Operator 3: quality rules as a short-circuit cascade.

Base measures of every whole text come first, with the base rule over them.
Documents that pass it go through a cascade of further rules, each with its
own share limit, and leave it at the first rule that rejects them. On a sample,
every rule's cost (time) and selectivity are measured; the cascade runs the
rules by falling rejection per cost. The order decides only how much work is
done: ``kept`` is the same in any order.

Defined cases: a null text has no words and fails the base rule, as do empty
and short texts; repeated rows are judged each; null doc_ids stay null; an
empty table gives no rows (rules then keep their given order); further columns
are ignored.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.llm.common import tidy

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: Documents on which rule costs and rejections are measured (expected number).
SAMPLE_ROWS = 2000

_CODES = range(0x110000)
_tables: dict[str, np.ndarray] = {}


def _table(kind: str) -> np.ndarray:
    """Which characters are letters or upper-case letters."""
    if kind not in _tables:
        test = {"letter": str.isalpha, "upper": str.isupper}[kind]
        _tables[kind] = np.fromiter((test(chr(c)) for c in _CODES), dtype=bool, count=len(_CODES))
    return _tables[kind]


class Measured:
    """A text and its measures; costly ones are made when a rule asks for them."""

    def __init__(self, text: str | None):
        self.text = text or ""
        words = self.text.encode("utf-8", "surrogatepass").split()  # white space: 0x20, 0x09-0x0D
        self.n_words = len(words)
        self.word_chars = len(self.text) - sum(map(self.text.count, WHITE))
        self.n_symbols = sum(map(self.text.count, SYMBOLS))
        lines = [x for x in self.text.split("\n") if x.strip(WHITE)]
        self.n_lines = len(lines)
        self.n_dup_lines = len(lines) - len(set(lines))
        self.n_repeat_words = _repeated(words)

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > 50 * self.n_words

    @cached_property
    def codes(self) -> np.ndarray:
        return np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _repeated(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more, each word once."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows) if len(set(windows)) < len(windows) else {}
    covered, upto = 0, 0
    if counts:
        for i, w in enumerate(windows):
            if counts[w] > 1:
                covered += i + 3 - max(i, upto)
                upto = i + 3
    return covered


def _mean_word(m: Measured) -> bool:
    return not 2.5 <= m.word_chars / m.n_words <= 12


def _symbol_share(m: Measured) -> bool:
    return m.n_symbols > 0.1 * m.n_words


def _line_repeats(m: Measured) -> bool:
    return m.n_dup_lines > 0.5 * m.n_lines


def _shouting(m: Measured) -> bool:
    return m.text.count("!") + m.text.count("?") > 0.3 * m.n_words


def _capitals(m: Measured) -> bool:
    letters = int(_table("letter")[m.codes].sum())
    return int(_table("upper")[m.codes].sum()) > 0.4 * letters


def _few_letters(m: Measured) -> bool:
    return int(_table("letter")[m.codes].sum()) < 0.6 * m.word_chars


@dataclass(frozen=True)
class Rule:
    """A named test; true rejects the document."""
    name: str
    rejects: Callable[[Measured], bool]


RULES = (
    Rule("capitals", _capitals),
    Rule("few_letters", _few_letters),
    Rule("shouting", _shouting),
    Rule("symbol_share", _symbol_share),
    Rule("line_repeats", _line_repeats),
    Rule("mean_word", _mean_word),
)


def rule_statistics(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per rule: documents of the sample, rejections and seconds spent.

    Every rule sees every sampled document that passes the base rule."""
    n = docs.count()
    share = min(1.0, sample_rows / max(n, 1))
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rejected, spent = 0, [0] * len(rules), [0.0] * len(rules)
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if Measured(text).base_failed:
                    continue
                seen += 1
                for i, rule in enumerate(rules):
                    m = Measured(text)
                    t = time.perf_counter()
                    rejected[i] += rule.rejects(m)
                    spent[i] += time.perf_counter() - t
        yield pa.RecordBatch.from_pydict({
            "rule": [r.name for r in rules], "seen": [seen] * len(rules),
            "rejected": rejected, "seconds": spent})

    parts = picked.select("text").mapInArrow(tidy(measure), "rule string, seen long, rejected long, seconds double")
    return parts.groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("seen", "rejected", "seconds")))


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                  sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """Rules by falling rejection per cost (one row per rule reaches the driver)."""
    stats = {r["rule"]: r for r in rule_statistics(docs, rules, sample_rows).collect()}

    def gain(rule: Rule) -> float:
        s = stats.get(rule.name)
        return (s["rejected"] + 1) / (s["seconds"] + 1e-9) if s and s["seen"] else 0.0

    return tuple(sorted(rules, key=gain, reverse=True))


JUDGED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


def judge(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Measures and verdict of every document; ``rejected_by`` names the rule
    that ended its cascade ("base" for the base rule, null if kept)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                m = Measured(text.as_py())
                by = "base" if m.base_failed else next((r.name for r in rules if r.rejects(m)), None)
                rows.append((doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines,
                             m.n_repeat_words, by == "base", by is None, by))
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[x.split()[0] for x in JUDGED.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), JUDGED)


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs, cascade_order(docs)).drop("rejected_by")


ORACLE_OP3 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS g FROM words),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM repeated) GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
measures AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines, length(regexp_replace(d.text, '[^!?]', '', 'g')) AS n_marks,
         length(regexp_replace(d.text, '\P{L}', '', 'g')) AS letters, length(regexp_replace(d.text, '\P{Lu}', '', 'g')) AS upper
  FROM docs d JOIN words w USING (r) LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.5 AND 12 AND n_symbols <= 0.1 * n_words
       AND n_dup_lines <= 0.5 * n_lines AND n_marks <= 0.3 * n_words AND upper <= 0.4 * letters
       AND letters >= 0.6 * word_chars AS kept
FROM base
"""
