"""Secret scans: known patterns, and strings that a primed compressor can't shorten.

The base kinds are patterns. The method looks at every long string in the neighbourhood of a
sensitive word and measures its marginal compressed bytes: what zstandard needs for the text around
it with the string, less what it needs without, when primed with a dictionary of identifiers that are
frequent in the corpus and of the code around, less the string's own repeats there. Words, identifiers
and frequent placeholders cost next to nothing; keys cost almost all of their bytes, and are reported
as often as they stand.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import slices

#: The patterns of the base kinds, in the order in which kinds are listed. Lengths are
#: checked after matching where a failing match takes text from those that follow it.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
# Runs of these characters are maximal either way, so asking for their length at once changes nothing.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Words that make their neighbourhood sensitive, in either case.
SENSITIVE = (
    "access", "api", "auth", "bearer", "cert", "client_id", "cookie", "credential", "key", "login",
    "passphrase", "passwd", "password", "private", "pwd", "secret", "session", "sig", "token",
)
_SENSITIVE = re.compile(r"(?<![a-z])(?:" + "|".join(SENSITIVE) + r")(?![a-z])|[a-z]*(?:password|passwd|secret|token|api_?key|credential)[a-z]*", re.ASCII)
#: Long strings between spaces, dots and what assigns ('=' and ':'), not all digits: ten digits carry
#: 0.42 bytes each. '=' stays at the end where it may be padding.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_.=-]))?")
_DOTTED = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-")
BEFORE, AROUND = 64, 256
#: Marginal bytes per byte from which a string counts as incompressible; text in 64 letters carries 0.75.
NOVEL = 0.6
#: Identifiers in the dictionary, the most frequent of the corpus; a parameter that bounds its size.
IDENTIFIERS = 4096


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of each base match; ``low`` is the text in lower case, to pass over most texts quickly."""
    found = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Novelty:
    """Marginal compressed bytes against a dictionary of identifiers and the text around."""

    def __init__(self, identifiers: list[str]):
        import zstandard

        self.zstd = zstandard
        self.words = " ".join(reversed(identifiers)).encode()  # the nearest bytes are the cheapest to refer to

    def cost(self, around: bytes, string: bytes) -> float:
        """Bytes that ``string`` adds, by byte of it."""
        primed = self.zstd.ZstdCompressionDict(self.words + b" " + around + b"\n", dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        compress = self.zstd.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False).compress
        return (len(compress(string)) - len(compress(b""))) / len(string)

    def spans(self, text: str, low: str) -> list[tuple[int, int, int]]:
        """Incompressible strings near a sensitive word; all parts of a dotted string are near what its start is near."""
        places = None
        out, end, origin = [], 0, 0
        for m in CANDIDATE.finditer(text):
            if places is None:
                places = np.array([s.end() for s in _SENSITIVE.finditer(low)], np.int64)
            a, b = m.span()
            # Where the dotted string starts that the candidate is a part of.
            start = a
            if a and text[a - 1] == ".":
                while start > end and text[start - 1] in _DOTTED:
                    start -= 1
                if start == end and end:
                    start = origin
            end, origin = b, start
            near = np.searchsorted(places, (start, a), side="right").tolist()
            if not any(k and at - places[k - 1] <= BEFORE for at, k in zip((start, a), near, strict=True)):
                continue
            # Repeats of the string itself are blanked, also those that the edges would cut.
            more, blank = AROUND + b - a, " " * (b - a)
            ahead = text[max(0, a - more) : a].replace(m[0], blank)[-AROUND:]
            around = (ahead + " " + text[b : b + more].replace(m[0], blank)[:AROUND]).encode("utf-8", "surrogatepass")
            if self.cost(around, m[0].encode()) >= NOVEL:
                out.append((a, 3, b))
        return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def lowered(text: str) -> str:
    """Lower case that keeps places: only characters that stay one character change."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def _scanned(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    novelty = Novelty(sent.value)
    for batch in slices(batches):
        counts, digests, every = [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            low = lowered(text)
            base = base_spans(text, low)
            counts.append([sum(k == n for _, k, _ in base) for n in range(3)])
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            every.append(listed(base + novelty.spans(text, low)))
        columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(digests), pa.array(every)],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def frequent_identifiers(docs: DataFrame, text: str = "text", most: int = IDENTIFIERS) -> list[str]:
    """The identifiers that most texts hold in lines with a sensitive word, over the whole corpus; at most ``most``.

    One in a single text is not frequent, however often it stands there: a key that is set and then used.
    """
    lines = F.filter(
        F.split(docs[text].cast("string"), "\n"),
        lambda x: F.lower(x).rlike("password|passwd|secret|token|api_?key|credential|private|auth"),
    )
    found = docs.select(F.array_join(lines, "\n").alias("lines")).select(
        F.explode(F.array_distinct(F.regexp_extract_all("lines", F.lit(r"[A-Za-z_][A-Za-z_]{3,40}"), F.lit(0)))).alias("w")
    )
    top = found.groupBy("w").count().where("count > 1").orderBy(F.desc("count"), "w").limit(most)
    return [r["w"] for r in top.collect()]


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = IDENTIFIERS) -> DataFrame:
    """Counts and spans per document row: ``kind:start:end`` in code points, end exclusive.

    A null or empty text has no spans, and repeated rows are reported as often. Spans of a kind don't
    overlap; a novel string may lie in a base match, and is the value without what assigns it, or a part between dots.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent_identifiers(docs, text, most))
    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    return source.mapInArrow(
        partial(_scanned, sent),
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )
