"""Plain versions of the URL models, to compare the operator with."""

from __future__ import annotations

import math
import zlib

from speechloom.llm.url_filter import ORDER


class Markov:
    """Counts of characters after contexts of 0 to `order` characters."""

    def __init__(self, urls: list[str], order: int = ORDER, letters: int = 256):
        self.order, self.letters = order, letters
        self.after: dict[str, dict[str, int]] = {}
        self.total: dict[str, int] = {}
        for u in urls:
            s = "\x02" * order + u + "\x03"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    seen = self.after.setdefault(s[i - k : i], {})
                    seen[s[i]] = seen.get(s[i], 0) + 1
        self.total = {c: sum(v.values()) for c, v in self.after.items()}

    def log(self, url: str) -> float:
        s, out, order = "\x02" * self.order + url + "\x03", 0.0, self.order
        for i in range(order, len(s)):
            p = 1 / self.letters
            for k in range(order + 1):
                seen = self.after.get(s[i - k : i])
                if seen is None:
                    break
                n, kinds = self.total[s[i - k : i]], len(seen)
                p = (seen.get(s[i], 0) + kinds * p) / (n + kinds)
            out += math.log(p)
        return out


class Ratio:
    def __init__(self, accepted: list[str], rejected: list[str]):
        self.only = "allow" if not rejected else "block" if not accepted else None
        self.threshold = 0.0
        if self.only:
            return
        back = lambda u: zlib.crc32(u.encode("utf-8", "surrogatepass")) % 4 == 0
        self.yes, self.no = Markov([u for u in accepted if not back(u)]), Markov([u for u in rejected if not back(u)])
        told = sorted([(self.difference(u), 1) for u in accepted if back(u)] + [(self.difference(u), 0) for u in rejected if back(u)])
        if told:
            errors = sum(1 for _, y in told if not y)  # everything allowed
            best, self.threshold = errors, told[0][0] - 1.0
            for k, (d, y) in enumerate(told):
                errors += 1 if y else -1
                if errors < best:
                    best, self.threshold = errors, (d + told[k + 1][0]) / 2 if k + 1 < len(told) else d + 1e-9

    def difference(self, url: str) -> float:
        """Of the log-likelihoods, per character."""
        return (self.yes.log(url) - self.no.log(url)) / len(url) if url else 0.0

    def verdict(self, url: str) -> tuple[str, float]:
        if self.only:
            return self.only, 0.0
        d = self.difference(url)
        return ("allow" if d >= self.threshold else "block"), d
