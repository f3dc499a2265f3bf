"""Secret scan: fixed patterns, and a token-efficiency test.

Text that a vocabulary was made for takes few tokens; a random string takes
about one token for every two characters. Long unbroken strings with a low
ratio of characters to tokens are reported, unless they are known digests or
identifiers.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds, in the order spans that start together are listed.
KINDS = ("assign", "access", "hex", "random")
#: A string with fewer characters per token is taken for random.
MAX_RATIO = 2.2
#: Characters per token below which no language's words fall, with letters only.
MAX_RATIO_LETTERS = 1.8
#: Lengths of hexadecimal digests in common use (MD5, SHA-1, SHA-224, -256, -384, -512).
DIGESTS = frozenset((32, 40, 56, 64, 96, 128))

# The patterns that the report is defined by.
_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                     r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")
_LEAST = {"assign": 6, "access": 20}

_STRING = re.compile("[A-Za-z0-9+/_=-]{20,}")
_HEX_ANY = re.compile("[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile("[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Parts of an identifier: CamelCase words, letters of one case, numbers; one separator between two of them at most.
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_SEPARATORS = re.compile(r"[-_/]")
_LETTERS_DIGITS = re.compile(r"[A-Za-z0-9]+")


@lru_cache(maxsize=1)
def vocabulary(path: str):
    """A tiktoken encoding from a file of ranks, once for each worker process."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "=" in text or ":" in text:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text)
                if m.end(1) - m.start(1) >= _LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST["access"]]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def is_identifier(s: str, encoding) -> bool:
    """Words, numbers or CamelCase parts joined by single separators. They have four characters or more
    on average and their letters take few tokens; a random string's parts don't."""
    pieces = _SEPARATORS.split(s)
    if not all(map(_LETTERS_DIGITS.fullmatch, pieces)):
        return False
    parts = [p for piece in pieces for p in _PART.findall(piece)]
    words = [p for p in parts if p[0] > "9"]
    if any(len(w) < 2 for w in words) or 4 * len(parts) > len(s):
        return False
    tokens = sum(len(encoding.encode_ordinary(w)) for w in words)
    return sum(map(len, words)) >= MAX_RATIO_LETTERS * tokens


def is_known(s: str, encoding) -> bool:
    """Digests and identifiers, which aren't secrets however few characters a token has."""
    return bool(_UUID.fullmatch(s) or (len(s) in DIGESTS and _HEX_ANY.fullmatch(s))) or is_identifier(s, encoding)


def is_random(s: str, encoding) -> bool:
    kinds = any(c.islower() for c in s) + any(c.isupper() for c in s) + any(c.isdigit() for c in s)
    ratio = len(s) / max(1, len(encoding.encode_ordinary(s)))
    return ratio < (MAX_RATIO if kinds >= 2 else MAX_RATIO_LETTERS) and len(set(s)) >= 10


def spans(text: str | None, encoding) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind. A random string is
    reported where no pattern has reported part of it."""
    text = text or ""
    out = base_spans(text)
    # Strings come in order and apart from each other: of the patterns' spans, by start, one pass says
    # which is the first that begins behind a string and how far those before it reach.
    taken, at, reach = sorted((s, e) for _, s, e in out), 0, 0
    for m in _STRING.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][0] < b:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= a and not is_known(m[0], encoding) and is_random(m[0], encoding):
            out.append(("random", a, b))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _scan(path: str):
    def run(batches):
        encoding = vocabulary(path)
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t.as_py(), encoding)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.struct([
                ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "found"])
    return run


def scan(docs: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, found: array of (kind, start, end)) for every row of ``docs``. A null
    text is empty and has none; rows that repeat are scanned each."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(ranks_path), "doc_id long, found array<struct<kind:string,start:bigint,end:bigint>>")
