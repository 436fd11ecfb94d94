"""Exact token counts at every prefix of a text, by dynamic programming.

Byte-pair encoding has one valid encoding for a string, and a sequence of tokens is that encoding exactly when every two
neighbours in it would not have been merged otherwise. So the encoding of a prefix that ends in token t is the encoding
of the prefix before t, followed by t, if t is compatible with that one's last token: a table over prefixes holds the
last token and the count, and each entry is found from earlier ones. `PrefixCounter.vector(text)` gives the count at
every prefix (in code points), the same as encoding that prefix anew; the total, the longest prefix within a budget, and
the number of tokens at any cut are look-ups in it.

A text is dealt with in chunks that begin at a single blank between two other characters. The pre-tokenizer never looks
across such a place, so a chunk's table doesn't depend on its surroundings; tables of chunks met before are kept in a
bounded memo, and a text's table is the chunks' tables, each raised by what stands before it.

Defined results: null and empty texts have 0 bytes and 0 tokens; strings of special tokens inside a text are one token
each, as by the library's default; repeated rows and rows with null ids are counted each; other columns are neither read nor returned.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Bounded, alone, ship, slices, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in out.values():
            out[chr(256 + n)] = b
            n += 1
    return out


#: Blanks between two other characters, where a text is cut into chunks.
CUT = re.compile(r"(?<=\S) (?=\S)")


def chunks(text: str) -> list[str]:
    """The text cut before each single blank between two non-blanks, without those blanks."""
    words = text.split()
    if sum(map(len, words)) + len(words) - 1 == len(text):  # single separators everywhere, none at the ends
        return text.split(" ")
    return CUT.split(text)


def packed(counts: Sequence[int]) -> bytes | np.ndarray:
    """A table in bytes if all its counts fit; a code point can be several tokens, and a longer prefix can have fewer."""
    return bytes(counts) if max(counts, default=0) < 256 else np.array(counts, dtype=np.uint32)


class PrefixCounter:
    """Counts tokens of every prefix under a byte-level BPE file with merges."""

    def __init__(self, path: str, memo: int = 180):
        """memo: megabytes of the table of chunks, of which the other tables get their shares."""
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normalizer or added blank is needed")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        raw = lambda s: bytes(letters[c] for c in s)
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        special = {t["content"] for t in spec["added_tokens"]}
        made = {a + b for a, b in self.rank} | {bytes([b]) for b in range(256)}
        self.tokens = sorted(t for t in made if len(t) == 1 or self._merge(t) == [t])
        # finds all tokens that end at each byte; bytes are told as Latin-1
        self.ends = ahocorasick.Automaton()
        for k, t in enumerate(self.tokens):
            self.ends.add_word(t.decode("latin-1"), (k, len(t)))
        self.ends.make_automaton()
        number = {t: k for k, t in enumerate(self.tokens)}
        self.made_at, self.halves = [-1] * len(number), [(-1, -1)] * len(number)
        self.rank_of_pair = {}
        for (a, b), k in self.rank.items():
            if a in number and b in number:
                self.rank_of_pair[number[a] << 20 | number[b]] = k
                if (n := number.get(a + b)) is not None and self._last_pair(a + b) == (a, b):
                    self.made_at[n], self.halves[n] = k, (number[a], number[b])
        self.special = [t for t in special if t]
        if any(re.search(r"\s", t) for t in self.special):
            raise ValueError("special tokens with blanks are not supported")
        self.split_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.blank, self.blanks = regex.compile(r"\s"), regex.compile(r"\s+")
        self.neighbours = Bounded(self._stay, 64, "token_counts")
        self.word_memo = Bounded(self._word, memo // 4, "token_counts")
        self.first_memo = Bounded(self._chunk, memo // 10, "token_counts")
        self.later_memo = Bounded(self._later, memo, "token_counts")

    def _merge(self, data: bytes) -> list[bytes]:
        """The definition: merge the pair of lowest rank until none is left. For short strings only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            k, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if k == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _last_pair(self, data: bytes) -> tuple[bytes, bytes]:
        """The two tokens that the last merge of a token's own encoding joins."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            _, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts[0], parts[1]

    def _stay(self, pair: int) -> bool:
        """Whether two tokens side by side are their string's encoding.

        A token's parts have lower ranks than itself, so merges happen in order of rank, and the rank is a clock. Going
        back in time, each pair of parts that once met at the border must not have been due for a merge while it lasted:
        a part lasts until its own token takes it in. At equal ranks the left merge comes first.
        """
        left, right = pair >> 20, pair & 0xFFFFF
        left_until = right_until = 1 << 60
        while True:
            due = self.rank_of_pair.get(left << 20 | right)
            if due is not None and due < left_until and due <= right_until:
                return False
            a, b = self.made_at[left], self.made_at[right]
            if a > b:
                left_until, left = a, self.halves[left][1]
            elif b >= 0:
                right_until, right = b, self.halves[right][0]
            else:
                return True

    def _word(self, word: str) -> tuple[int, ...]:
        """Counts at every code point of one pre-token: the dynamic programme over its bytes."""
        data = word.encode("utf-8", "surrogatepass")
        n, neighbours = len(data), self.neighbours
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for at, (token, width) in self.ends.iter(data.decode("latin-1")):
            end = at + 1
            if last[end] < 0:
                start = end - width
                if not start or neighbours[last[start] << 20 | token]:
                    last[end], count[end] = token, count[start] + 1
        if n == len(word):
            return tuple(count[1:])
        ends, at = [], 0
        for c in word:
            at += len(c.encode("utf-8", "surrogatepass"))
            ends.append(count[at])
        return tuple(ends)

    def _plain(self, text: str) -> list[int]:
        """Counts at every code point of a text without special tokens."""
        out: list[int] = []
        before, at, words = 0, 0, self.word_memo
        for word in self.words.findall(text):
            counts = words[word]
            if word[0] == "'" and len(word) > 1 and word[1].isalpha():  # a contraction's prefixes are two words until it is whole
                out.extend(before + sum(words[w][-1] for w in self.words.findall(word[:k])) for k in range(1, len(word)))
                out.append(before + counts[-1])
            elif self.blank.match(word) and (at == 0 or not self.blank.match(text[at - 1])):
                # a prefix that ends in blanks has all of them in one word, also the one that the next word takes
                run = self.blanks.match(text, at).group()
                whole = words[run] if len(run) < 64 else self._word(run)
                k = min(len(word), len(run))
                out.extend(before + c for c in whole[:k])
                out.extend(before + c for c in counts[k:])
                out.extend(before + c for c in whole[k:])
            elif at and self.blank.match(text[at - 1]) and self.blank.match(word):  # its first blank is told already
                out.extend(before + c for c in counts[1:])
            else:
                out.extend(before + c for c in counts)
            before, at = before + counts[-1], at + len(word)
        return out

    def _later(self, piece: str) -> bytes | np.ndarray:
        """The table of a chunk that follows a blank."""
        if piece.isalpha() and len(piece) < 100:  # one pre-token
            return packed(self._word(" " + piece))
        if piece[-1:] in (".", ",") and piece[:-1].isalpha() and len(piece) < 100:  # two
            head = self.later_memo[piece[:-1]]
            if isinstance(head, bytes) and head[-1] < 255:
                return head + bytes([head[-1] + 1])
            return packed([*map(int, head), int(head[-1]) + 1])
        return self._chunk(" " + piece)

    def _chunk(self, text: str) -> bytes | np.ndarray:
        out: list[int] = []
        if self.split_special is None or not self.split_special.search(text):
            out = self._plain(text)
        else:
            base = 0
            parts = self.split_special.split(text)
            for k in range(0, len(parts), 2):
                part = parts[k]
                if k + 1 < len(parts):  # inside the special string, the prefix is ordinary text
                    counts = self._plain(part + parts[k + 1][:-1])
                    out.extend(base + c for c in counts)
                    base += (self._plain(part)[-1] if part else 0) + 1
                    out.append(base)
                elif part:
                    out.extend(base + c for c in self._plain(part))
        return packed(out)

    def tables(self, text: str) -> list:
        """The chunks' tables in order."""
        if not text:
            return []
        pieces = chunks(text)
        return [self.first_memo[pieces[0]], *map(self.later_memo.__getitem__, pieces[1:])]

    def count(self, text: str | None) -> int:
        return int(sum(t[-1] for t in self.tables(text or "")))

    def vector(self, text: str | None) -> np.ndarray:
        """Entry i is the number of tokens of the first i code points."""
        out, base = [np.zeros(1, np.int64)], 0
        for t in self.tables(text or ""):
            part = np.frombuffer(t, np.uint8) if isinstance(t, bytes) else t
            out.append(part.astype(np.int64) + base)
            base += int(part[-1])
        return np.concatenate(out)

    def summary(self, text: str | None, budget: int) -> tuple[int, int]:
        """(tokens, code points of the longest prefix of at most `budget` tokens), from the chunks' tables alone."""
        tables = self.tables(text or "")
        totals = [t[-1] for t in tables]
        n = int(sum(totals))
        if n <= budget:
            return n, len(text or "")
        starts = np.cumsum([0, *totals])
        k = int(np.searchsorted(starts, budget, "right")) - 1  # the last chunk that begins within the budget
        room = budget - int(starts[k])
        return n, sum(map(len, tables[:k])) + max((i for i, c in enumerate(tables[k], 1) if c <= room), default=0)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, budget: int = 1024, prefixes: bool = False) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit, fit_chars[, prefix_counts]) for each row.

    fit_chars: code points of the longest prefix with at most `budget` tokens. prefix_counts: the whole table, on request.
    """
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + ", prefix_counts array<int>" * prefixes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("token_counts")
        c = counter(vocabulary_path(vocabulary))
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            got = [c.summary(t, budget) for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            n = pa.array([x[0] for x in got], pa.int64())
            cols = [b.column(0), pa.array(size, pa.int64()), n, pa.array([x[0] > budget for x in got], pa.bool_()), pa.array([x[1] for x in got], pa.int64())]
            names = [id_col, "n_bytes", "n_tokens", "over_limit", "fit_chars"]
            if prefixes:
                cols.append(pa.array([c.vector(t).astype(np.int32) for t in texts], pa.list_(pa.int32())))
                names.append("prefix_counts")
            yield pa.RecordBatch.from_arrays(cols, names)

    return source.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
