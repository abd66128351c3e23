"""Text normalisation. What Spark's own functions can say stays a Column; the rest runs in Arrow batches."""

from __future__ import annotations

import difflib
import re
import unicodedata
from urllib.parse import urlsplit, urlunsplit

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

NBSP = " "


def _bare(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def plain(text: str | None) -> str:
    """Case-folded before decomposition; runs of anything but a-z and 0-9 become one space. Null gives ''."""
    return "" if text is None else re.sub("[^a-z0-9]+", " ", _bare(str(text).casefold())).strip()


def plain_name(text: str | None) -> str:
    """Decomposed before case folding; otherwise like plain(). The two differ for letters that fold to several."""
    return "" if text is None else " ".join(re.sub("[^a-z0-9]+", " ", _bare(str(text)).casefold().replace("’", "'")).split())


def slug(text: str) -> str:
    """ASCII letters and digits in lower case, all else as single underscores."""
    ascii_ = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    return re.sub("_+", "_", "".join(c.lower() if c.isalnum() else "_" for c in ascii_)).strip("_")


def plain_url(url: str | None) -> str:
    """Scheme in lower case, host folded without a leading www., path without final slashes; query and fragment go. Without
    a scheme there is no host, and the text is a path."""
    if url is None or not str(url).strip():
        return ""
    parts = urlsplit(str(url).strip())
    return urlunsplit((parts.scheme.casefold(), parts.netloc.casefold().removeprefix("www."), parts.path.rstrip("/"), "", ""))


def similarity(a: str, b: str) -> float:
    """Ratcliff-Obershelp ratio."""
    return difflib.SequenceMatcher(None, a, b).ratio()


class Names:
    """Texts that many others are compared with. ``bound`` is never below ``similarity``: matching blocks are a common
    subsequence, and that has no more letters than both texts share, in whatever order."""

    WIDTH = 64  # longer texts are bounded by their letters only
    OTHER = 37

    def __init__(self, names: list[str]):
        self.names = names
        self.sizes = np.array([len(n) for n in names], dtype=np.int64)
        width = min(self.WIDTH, int(self.sizes.max(initial=0)))
        self.codes = np.full((len(names), width), self.OTHER + 1, np.uint8)  # a code that no letter has fills up
        self.counts = np.zeros((self.OTHER + 1, len(names)), np.int32)
        for i, name in enumerate(names):
            codes = self._codes(name)
            self.codes[i, : min(len(codes), width)] = codes[:width]
            self.counts[:, i] = np.bincount(codes, minlength=self.OTHER + 1)

    @classmethod
    def _codes(cls, name: str) -> np.ndarray:
        """a-z, 0-9 and the space have codes of their own, all others have one."""
        code = lambda c: ord(c) - 97 if "a" <= c <= "z" else ord(c) - 22 if "0" <= c <= "9" else 36 if c == " " else cls.OTHER
        return np.array([code(c) for c in name], dtype=np.int64)

    def _ratio(self, shared: np.ndarray, which: np.ndarray, other: str) -> np.ndarray:
        total = self.sizes[which] + len(other)
        return np.where(total > 0, 2.0 * shared / np.maximum(total, 1), 1.0)

    def bound(self, other: str, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the names that may be as similar to the other text as ``least``, and their bounds."""
        codes = self._codes(other)
        shared = np.zeros(len(self.names), np.int32)
        for letter, n in zip(*np.unique(codes, return_counts=True)):
            shared += np.minimum(self.counts[letter], n)
        which = np.arange(len(self.names))
        bounds = self._ratio(shared, which, other)
        which, bounds = which[bounds >= least], bounds[bounds >= least]
        if len(which) == 0 or len(other) > self.WIDTH:
            return which, bounds
        # longest common subsequences, all names at once: a bit for each letter of the other text (Hyyro's form)
        masks = np.zeros(self.OTHER + 2, np.uint64)
        for i, letter in enumerate(codes.tolist()):
            masks[letter] |= np.uint64(1) << np.uint64(i)
        row = np.full(len(which), np.uint64(2**64 - 1))
        for place in range(self.codes.shape[1]):
            hit = row & masks[self.codes[which, place]]
            row = (row + hit) | (row - hit)
        whole = np.uint64((1 << len(other)) - 1)
        common = np.bitwise_count(~row & whole)
        bounds = np.where(self.sizes[which] > self.WIDTH, bounds, self._ratio(common, which, other))
        return which[bounds >= least], bounds[bounds >= least]

    def nearest(self, other: str, least: float, weights: np.ndarray, enough: int) -> list[tuple[int, float]]:
        """(place, similarity) of the names at least as similar as ``least``, the most similar first: as far as their weights
        add up to ``enough``, and all that are as similar as the last of these."""
        which, bounds = self.bound(other, least)
        found: list[tuple[int, float]] = []
        for k in np.argsort(-bounds, kind="stable"):
            if bounds[k] < least:
                break
            score = similarity(self.names[which[k]], other)
            if score < least:
                continue
            found.append((int(which[k]), score))
            if len(found) % 16 == 0 or sum(weights[p] for p, _ in found) >= enough:
                least, found = self._cut(found, least, weights, enough)
        return self._cut(found, least, weights, enough)[1]

    @staticmethod
    def _cut(found: list[tuple[int, float]], least: float, weights: np.ndarray, enough: int) -> tuple[float, list[tuple[int, float]]]:
        found = sorted(found, key=lambda f: -f[1])
        seen = 0
        for place, score in found:
            seen += weights[place]
            if seen >= enough:
                least = max(least, score)
                break
        return least, [f for f in found if f[1] >= least]


@pandas_udf(StringType())
def normalized_text(s: pd.Series) -> pd.Series:
    return s.map(lambda x: plain(None if pd.isna(x) else x))


@pandas_udf(StringType())
def normalized_name(s: pd.Series) -> pd.Series:
    return s.map(lambda x: plain_name(None if pd.isna(x) else x))


@pandas_udf(StringType())
def slugified(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if pd.isna(x) else slug(x))


@pandas_udf(StringType())
def normalized_url(s: pd.Series) -> pd.Series:
    return s.map(lambda x: plain_url(None if pd.isna(x) else x))


@pandas_udf(DoubleType())
def sequence_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@pandas_udf(StringType())
def float_text(s: pd.Series) -> pd.Series:
    """Shortest text of a double, as in 0.0001 (Spark would print 1.0E-4)."""
    return s.map(lambda x: None if pd.isna(x) else repr(float(x)))


def without_nbsp(c: Column) -> Column:
    return F.translate(c, NBSP, "")


def postal_code(c: Column) -> Column:
    """The first group of exactly five digits, or ''."""
    return F.coalesce(F.regexp_extract(c, r"(?U)\b(\d{5})\b", 1), F.lit(""))


def department_code(postcode: Column) -> Column:
    """First two digits; Corsican codes by their third."""
    two, three = F.substring(postcode, 1, 2), F.substring(postcode, 1, 3)
    return F.when(three.isin("200", "201"), "2A").when(three == "202", "2B").otherwise(two)


def paris_arrondissement(location: Column) -> Column:
    """1 to 20 from 'Paris, 75xxx'; 00 is the 20th and 75116 the 16th; null elsewhere."""
    code = F.nullif(F.regexp_extract(location, r"Paris, (75\d{3})$", 1), F.lit(""))
    number = F.substring(code, -2, 2).cast("int")
    return F.when(code == "75116", 16).when(number == 0, 20).otherwise(number)


def display_name(app: Column) -> Column:
    """Text before the first ' ou ', without a leading 'Alsace grand cru'."""
    return F.trim(F.regexp_replace(F.split_part(app, F.lit(" ou "), F.lit(1)), r"(?i)^Alsace grand cru\s+", ""))


def region_label(region: Column) -> Column:
    return F.trim(F.regexp_replace(region, r"(?i)^region\s+", ""))


def ordinal_label(ordinal: Column, name: Column) -> Column:
    return F.format_string("%s (%s)", ordinal, name)
