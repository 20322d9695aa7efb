"""Operator 4: language identification by cross-parsing entropy.

From a bounded sample of labelled text per language a suffix automaton is
built. A document is cross-parsed against each automaton: the longest match
from the current place is one phrase, and the next phrase starts behind it. A
language that fits gives long matches, so few phrases. Phrases are normalised
by the sample's size and the text's length (phrases * log2(sample) / length; the length is the same for all languages); the language
with the least of that entropy wins. ``score`` = 1 - best / second.

The sample is the only bounded part: ``SAMPLE_DOCS`` documents a language in
hash order, ``SAMPLE_CHARS`` characters of each. Every document is parsed whole.
Its text lies in lanes of ``LANE`` characters that numpy advances together, each
from the root; then each lane is repeated from the state in which the one before
it truly ended, until it meets its first parse (two parses of a text soon fall
together), so phrases are those of the text and not of lanes.

All letters of the samples are symbols. The ``DENSE_LETTERS`` most frequent ones
have a column in the transition table, the others' transitions are looked up.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
ties go to the language with more learnable documents, then by name; documents
without lang or doc_id are never learned from, nor are held-out ones in any way,
and a null doc_id counts as held out; repeated rows are predicted each; a language
whose learnable texts have no letter is not learned; letters that no sample has
are phrases of their own in every language; without any labelled row all is
``und``; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormmart.llm.common import loaded, tidy

SAMPLE_DOCS = 64
SAMPLE_CHARS = 500
LANE = 256
#: States that are kept of lanes advanced together (bounds a task's memory).
STATES_AT_ONCE = 4_000_000
FOLDS = 5
UNKNOWN = "und"

# Symbol classes: every run of non-letters is one GAP, letters that no sample
# has are OTHER, BREAK separates sampled documents, PAD fills up lanes.
GAP, OTHER, BREAK, PAD, FIRST_LETTER = 0, 1, 2, 3, 4
#: Letters with a column of their own in the transition table.
DENSE_LETTERS = 120


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32 of the id (as text) is divisible by ``FOLDS``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def learning_sample(docs: DataFrame, n_docs: int = SAMPLE_DOCS,
                    n_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Bounded labelled text per language, on the driver, frequent languages first.

    The rank limit is applied in every task before the shuffle, so a language
    that holds most rows sends no more than another."""
    learnable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # A letter somewhere in the part that is learned from.
    labelled = (learnable.select("lang", F.xxhash64("doc_id").alias("h"), "doc_id",
                                 F.substring("text", 1, n_chars).alias("text"))
                .where(F.col("text").rlike(r"\p{L}")))
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    rows = labelled.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n_docs).collect()
    sizes = {r["lang"]: r["count"] for r in learnable.groupBy("lang").count().collect()}
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (-sizes[r["lang"]], r["lang"], r["rn"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``symbols``: for each state its
    symbols and where they lead; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class CrossParser:
    """Automata of all languages in one table, and the parse of whole texts."""

    def __init__(self, sample: dict[str, list[str]]):
        self.languages = list(sample)
        letters = Counter(c for texts in sample.values() for t in texts for c in t.lower() if c.isalpha())
        known = {c: FIRST_LETTER + i for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0])))}
        self.n_symbols = FIRST_LETTER + len(known)
        self.n_dense = min(self.n_symbols, FIRST_LETTER + DENSE_LETTERS)
        self.class_of = np.zeros(0x110000, dtype=np.int32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                self.class_of[code] = known.get(c.lower(), OTHER)
        automata = []
        for lang in self.languages:
            symbols: list[int] = []
            for text in sample[lang]:
                symbols += [*self.symbols(text).tolist(), BREAK]
            automata.append((suffix_automaton(symbols), math.log2(max(2, len(symbols)))))
        self.bits = [bits for _, bits in automata]
        n_states = sum(len(nxt) + 1 for nxt, _ in automata)
        # A state is its row's place in the table; the bit above says that a phrase ended.
        wide = n_states * self.n_dense >= 1 << 30
        self.kind, self.shift = (np.int64, 62) if wide else (np.int32, 30)
        self.restart = self.kind(1 << self.shift)
        tables, rare, self.roots, self.alone, base = [], [], [], [], 0
        for nxt, _ in automata:
            dense = np.full((len(nxt) + 1, self.n_dense), -1, dtype=np.int64)
            for s, edges in enumerate(nxt):
                for c, t in edges.items():
                    if c < self.n_dense:
                        dense[s, c] = t
                    else:
                        rare.append(((base + s) * self.n_symbols + c, (base + t) * self.n_dense))
            dense[:, [BREAK, OTHER]] = -1
            # No edge: a phrase ends, and the next one starts with this symbol. A
            # symbol that the sample lacks is a phrase of its own, which the last
            # state stands for. At the root no phrase has begun that could end.
            alone = len(nxt)
            again = np.where(dense[0] >= 0, dense[0], alone)
            to = (np.where(dense >= 0, dense, again) + base) * self.n_dense
            flag = (dense < 0) * int(self.restart)
            flag[0] = 0
            full = to | flag
            full[:, PAD] = (np.arange(len(dense)) + base) * self.n_dense
            tables.append(full.astype(self.kind))
            self.roots.append(base * self.n_dense)
            self.alone.append((base + alone) * self.n_dense)
            base += len(dense)
        self.table = np.concatenate([t.ravel() for t in tables]) if tables else np.zeros(0, dtype=np.int32)
        rare.sort()
        self.rare_keys = np.array([k for k, _ in rare], dtype=np.int64)
        self.rare_to = np.array([t for _, t in rare], dtype=self.kind)

    def symbols(self, text: str) -> np.ndarray:
        """Symbol classes of a text; runs of non-letters become one gap."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        classes = self.class_of[codes]
        if len(classes):
            keep = classes != GAP
            keep[1:] |= classes[:-1] != GAP
            classes = classes[keep]
        return classes

    def _rare(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states for symbols that have no column of their own."""
        def edge(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keys = at.astype(np.int64) // self.n_dense * self.n_symbols + symbol
            i = np.minimum(np.searchsorted(self.rare_keys, keys), len(self.rare_keys) - 1)
            return self.rare_keys[i] == keys, self.rare_to[i]

        lang = np.searchsorted(self.roots, state, side="right") - 1
        start = np.array(self.roots)[lang]
        found, to = edge(state)
        there, first = edge(start)
        again = np.where(there, first, np.array(self.alone, dtype=self.kind)[lang])
        return np.where(found, to, again | np.where(state == start, 0, self.restart)).astype(self.kind)

    def _next(self, state: np.ndarray, symbol: np.ndarray, any_rare: bool) -> np.ndarray:
        """States after one more symbol each, with the bit of an ended phrase."""
        if not any_rare:
            return self.table.take(state + symbol)
        rare = symbol >= self.n_dense
        out = self.table.take(state + np.where(rare, PAD, symbol))
        rare = np.broadcast_to(rare, state.shape)
        out[rare] = self._rare(state[rare], np.broadcast_to(symbol, state.shape)[rare])
        return out

    def phrases(self, symbols: list[np.ndarray]) -> np.ndarray:
        """Phrases of every text against every language (texts x languages)."""
        sizes = np.array([len(s) for s in symbols], dtype=np.int64)  # also of no texts
        lanes = -(-sizes // LANE)
        text_of_lane = np.repeat(np.arange(len(symbols)), lanes)
        padded = np.full(int(lanes.sum()) * LANE, PAD, dtype=self.kind)
        at = 0
        for s, k in zip(symbols, lanes):
            padded[at:at + len(s)] = s
            at += int(k) * LANE
        counts = np.zeros((len(symbols), len(self.languages)))
        grid = padded.reshape(-1, LANE)
        follows = np.zeros(len(grid), dtype=bool)
        follows[1:] = text_of_lane[1:] == text_of_lane[:-1]
        at_once = max(16, STATES_AT_ONCE // (LANE * max(1, len(self.languages))))
        ends = np.array(self.roots, dtype=self.kind)
        for i in range(0, len(grid), at_once):
            steps = np.ascontiguousarray(grid[i:i + at_once].T)
            got, ends = self._advance(steps, follows[i:i + at_once], ends)
            for k in range(len(self.languages)):
                counts[:, k] += np.bincount(text_of_lane[i:i + at_once], got[k], minlength=len(symbols))
        return counts + (sizes > 0)[:, None]  # the phrase that the text's end closes

    def _advance(self, steps: np.ndarray, follows: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in every lane (languages x lanes), and the last lane's
        states. ``follows``: the lane goes on with the text of the one before it;
        ``before``: the states in which the lane before the first one ended."""
        mask = ~self.restart
        rare = (steps >= self.n_dense).any(axis=1).tolist()
        state = np.repeat(np.array(self.roots, dtype=self.kind)[:, None], steps.shape[1], axis=1)
        if follows[0]:
            state[:, 0] = before
        seen = np.empty((LANE, *state.shape), dtype=self.kind)
        for t, row in enumerate(steps):
            seen[t] = self._next(state, row, rare[t])
            state = seen[t] & mask
        # Lanes again, from the state in which the one before truly ends, until
        # they meet what was seen; where a lane's end changes, the next one again.
        again = follows & (np.arange(len(follows)) > 0)
        lang, lane = np.nonzero(np.broadcast_to(again, state.shape))
        while len(lane):
            state = seen[-1][lang, lane - 1] & mask
            for t, row in enumerate(steps):
                new, old = self._next(state, row[lane], rare[t]), seen[t][lang, lane]
                seen[t][lang, lane] = new
                apart = (new & mask) != (old & mask)
                state, lang, lane = (new & mask)[apart], lang[apart], lane[apart]
                if not len(lane):
                    break
            on = lane + 1 < len(follows)
            lang, lane = lang[on], lane[on] + 1
            on = follows[lane]
            lang, lane = lang[on], lane[on]
        return (seen >> self.shift).sum(axis=0, dtype=np.int64), seen[-1][:, -1] & mask

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        symbols = [self.symbols(t or "") for t in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        entropy = self.phrases(symbols) * np.array(self.bits)
        out = []
        for s, row in zip(symbols, entropy):
            if not (s != GAP).any():
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmin(row))
            second = np.delete(row, best).min() if len(row) > 1 else np.inf
            out.append((self.languages[best], float(1 - row[best] / second) if second else 0.0))
        return out


def _parser(sample: dict[str, list[str]]) -> CrossParser:
    return loaded("language", hash(tuple((k, tuple(v)) for k, v in sample.items())), lambda: CrossParser(sample))


#: Characters of text that are parsed together.
CHARS_AT_ONCE = 1_000_000


def identify(docs: DataFrame, sample: dict[str, list[str]], keep: tuple[str, ...] = ("doc_id",),
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of every row with the predicted language and its score."""
    # The text crosses once: as a column to keep, or beside them.
    cols = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields if f.name in keep)
    at = cols.columns.index("text")

    cols_in = cols.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(sample)
        for batch in batches:
            texts = batch.column(at)
            found, some, size = [], [], 0
            for text in texts:
                some.append(text.as_py())
                size += len(some[-1] or "")
                if size > CHARS_AT_ONCE:
                    found += parser.predict(some)
                    some, size = [], 0
            found += parser.predict(some)
            arrays = [batch.column(i) for i, c in enumerate(cols_in) if c in keep]
            arrays += [pa.array([x[0] for x in found], pa.string()),
                       pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    return cols.mapInArrow(tidy(run, "language"), f"{schema}, `{names[0]}` string, `{names[1]}` double")


def op4_cross_parsing_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (identify(docs, learning_sample(docs))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))
