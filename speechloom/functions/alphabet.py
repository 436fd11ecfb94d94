"""Codec alphabet: one character for each (codebook, code), frame by frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value), with the value computed once: a lambda's body computes what it takes from outside again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


LOW_SURROGATE, HIGH_SURROGATE = 0xD800, 0xDFFF


@dataclass(frozen=True)
class Alphabet:
    """Characters `offset + codebook * size + code`. The defaults cross out of the basic plane: U+E000 to U+11FFF."""

    offset: int = 0xE000
    codebooks: int = 8
    size: int = 2048

    def __post_init__(self) -> None:
        upper = self.offset + self.codebooks * self.size
        if self.offset < HIGH_SURROGATE and upper > LOW_SURROGATE:
            raise ValueError(f"characters {self.offset:#x} to {upper:#x} meet the surrogates")

    def _class(self, first: int, last: int) -> str:
        """A regex class of the characters of codebooks first to last."""
        return f"\\x{{{self.offset + first * self.size:X}}}-\\x{{{self.offset + (last + 1) * self.size - 1:X}}}"

    def truncated(self, codes: Column) -> Column:
        """The codebooks that the alphabet has; further ones are dropped."""
        return F.slice(codes, 1, self.codebooks)

    def interleaved(self, codes: Column) -> Column:
        """Code points of int[codebook][frame], frame by frame."""
        def body(m: Column) -> Column:
            frames = F.size(F.get(m, F.lit(0)))
            one = lambda t: F.transform(m, lambda row, k: F.get(row, t) + F.lit(self.offset) + k * F.lit(self.size))
            return F.when(frames > 0, F.flatten(F.transform(F.sequence(F.lit(0), frames - 1), one))).otherwise(F.array().cast("array<int>"))

        return let(self.truncated(codes), body)

    def encode(self, codes: Column) -> Column:
        """The string of a code matrix. The whole string is decoded at once: its first character is of codebook 0,
        so it is never a byte-order mark that the decoder would take away."""
        points = F.transform(self.interleaved(codes), lambda c: F.lpad(F.hex(c.cast("long")), 8, "0"))
        return F.decode(F.unhex(F.array_join(points, "")), "UTF-32")

    def points(self, text: Column) -> Column:
        """Code points of a string; ascii() gives the whole code point."""
        return F.when(F.length(text) > 0, F.transform(F.split(text, ""), lambda c: F.ascii(c))).otherwise(F.array().cast("array<int>"))

    def decode(self, text: Column) -> Column:
        """int[codebook][frame] of a string of whole frames; anything else stops the job."""
        frames = (F.length(text) / self.codebooks).cast("int")
        ragged = F.length(text) % self.codebooks != 0

        def body(points: Column) -> Column:
            n = (F.size(points) / self.codebooks).cast("int")
            one = lambda k: F.transform(F.sequence(F.lit(0), n - 1), lambda t: F.get(points, t * self.codebooks + k) - self.offset - k * self.size)
            return F.transform(F.sequence(F.lit(0), F.lit(self.codebooks - 1)), one)

        empty = F.array(*[F.array().cast("array<int>")] * self.codebooks)
        stop = F.raise_error(F.lit("length is not a multiple of the codebooks")).cast("array<array<int>>")
        return F.when(ragged, stop).when(frames == 0, empty).otherwise(let(self.points(text), body))

    def codebook(self, point: Column) -> Column:
        """The highest codebook that begins at or below a code point; -1 below all. There is no upper bound."""
        return F.greatest(F.lit(-1), F.least(F.lit(self.codebooks - 1), F.floor((point - self.offset) / self.size).cast("int")))

    def trimmed(self, text: Column) -> Column:
        """struct(begin, body, end): what hangs before the first frame and after the last."""
        begin = F.regexp_extract(text, f"^([^{self._class(0, 0)}]*)", 1)
        rest = F.substr(text, F.length(begin) + 1, F.length(text))
        body = F.regexp_extract(rest, f"^((?:[\\s\\S]*[{self._class(self.codebooks - 1, self.codebooks - 1)}])?)", 1)
        return F.struct(begin.alias("begin"), body.alias("body"), F.substr(rest, F.length(body) + 1, F.length(rest)).alias("end"))

    def consistent(self, text: Column) -> Column:
        """The characters kept by the automaton that waits for codebook after codebook, from that of the first.

        A fold copies its list at each kept character, so the string is folded in stretches of the root of its length:
        one fold over a stretch, and one over the stretches that carries the codebook waited for and gathers their lists.
        """

        def body(points: Column) -> Column:
            n = F.size(points)
            width = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
            begins = F.filter(F.sequence(F.lit(0), n, width), lambda k: k < n)
            first = F.greatest(F.lit(0), self.codebook(F.get(points, F.lit(0))))

            def step(a: Column, c: Column) -> Column:
                hit = self.codebook(c) == a["wait"]
                return F.struct(
                    F.when(hit, (a["wait"] + 1) % self.codebooks).otherwise(a["wait"]).alias("wait"),
                    F.when(hit, F.concat(a["kept"], F.array(a["at"]))).otherwise(a["kept"]).alias("kept"),
                    (a["at"] + 1).alias("at"),
                )

            def stretch(a: Column, begin: Column) -> Column:
                start = F.struct(a["wait"].alias("wait"), F.array().cast("array<int>").alias("kept"), begin.alias("at"))
                done = F.aggregate(F.slice(points, begin + 1, width), start, step)
                return let(done, lambda d: F.struct(d["wait"].alias("wait"), F.concat(a["kept"], F.array(d["kept"])).alias("kept")))

            return F.flatten(F.aggregate(begins, F.struct(first.alias("wait"), F.array().cast("array<array<int>>").alias("kept")), stretch, lambda a: a["kept"]))

        kept = let(self.points(text), body)
        chosen = let(F.split(text, ""), lambda letters: F.array_join(F.transform(kept, lambda i: F.get(letters, i)), ""))
        return F.when(F.length(text) == 0, F.lit("")).otherwise(chosen)

    def robust(self, text: Column) -> Column:
        """The code matrix of any string: inconsistent characters dropped, then hanging ones."""
        return self.decode(self.trimmed(self.consistent(text))["body"])

    def chunked(self, codes: Column, frames: int) -> Column:
        """Matrices of at most `frames` frames, in order."""
        total = F.size(F.get(codes, F.lit(0)))
        cut = lambda i: F.transform(codes, lambda row: F.slice(row, i + 1, F.lit(frames)))
        return F.when(total > 0, F.transform(F.sequence(F.lit(0), total - 1, F.lit(frames)), cut)).otherwise(F.array().cast("array<array<array<int>>>"))

    def semantic_pattern(self) -> str:
        return f"([{self._class(0, 0)}])[{self._class(1, self.codebooks - 1)}]{{{self.codebooks - 1}}}"
