"""Golomb-Rice codes of sorted integers, and the duplicate-finding exchange
built on them: senders ship sorted compressed fingerprints to hash owners, each
distinct one of a chunk once, and get back one bit for each that says whether it
occurs more than once.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fingerprints an owner holds at once on average (8 bytes each, once decoded); copies of one
#: count once a chunk of a sender, so a group of copies adds no more than there are chunks.
PER_OWNER = 2_000_000
#: Extra fingerprint bits over log2(number of fingerprints): one false suspect in 2**EXTRA_BITS.
EXTRA_BITS = 8
#: Fingerprints up to which the owners' bitmaps are broadcast.
BROADCAST_BITS = 128_000_000


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted non-negative integers (repeats allowed) -> gaps as quotient in
    unary and remainder in k bits, k from the mean gap."""
    v = np.asarray(values, dtype=np.int64)
    if not len(v):
        return b""
    gaps = np.diff(v, prepend=0)
    k = max(0, int(max(1, v[-1] // len(v))).bit_length() - 1)
    ends = np.cumsum((gaps >> k) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    packed = np.packbits(unary).tobytes()
    rest = np.packbits(((gaps[:, None] >> np.arange(k)) & 1).astype(np.uint8)).tobytes() if k else b""
    return struct.pack("<BII", k, len(v), len(packed)) + packed + rest


def rice_decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, dtype=np.int64)
    k, n, size = struct.unpack_from("<BII", blob)
    unary = np.unpackbits(np.frombuffer(blob, np.uint8, size, 9))
    ends = np.flatnonzero(unary)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1) << k
    if k:
        bits = np.unpackbits(np.frombuffer(blob, np.uint8, offset=9 + size), count=n * k)
        gaps = gaps + bits.reshape(n, k) @ (np.int64(1) << np.arange(k, dtype=np.int64))
    return np.cumsum(gaps)


def counted_encode(values: np.ndarray) -> bytes:
    """Sorted non-negative integers -> the distinct ones, which of them repeat, and how often."""
    distinct, counts = np.unique(np.asarray(values, np.int64), return_counts=True)
    at = np.flatnonzero(counts > 1)
    codes = rice_encode(distinct), rice_encode(at), rice_encode(np.cumsum(counts[at]))
    return struct.pack("<II", *map(len, codes[:2])) + b"".join(codes)


def counted_decode(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, how often each occurs)."""
    first, second = struct.unpack_from("<II", blob)
    first, second = 8 + first, 8 + first + second
    distinct = rice_decode(blob[8:first])
    counts = np.ones(len(distinct), np.int64)
    counts[rice_decode(blob[first:second])] = np.diff(rice_decode(blob[second:]), prepend=0)
    return distinct, counts


def answered(blob: bytes, bitmap: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A message's values, repeats included, and whether each occurs again anywhere."""
    distinct, counts = counted_decode(blob)
    hit = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(distinct)).astype(bool)
    return np.repeat(distinct, counts), np.repeat(hit, counts)


class Universe:
    """Owners and the value range of each, from the number of fingerprints."""

    def __init__(self, n: int, least: int):
        self.owners = max(1, least, -(-n // PER_OWNER))
        self.bits = min(62, max(1, -(-n // self.owners)).bit_length() + EXTRA_BITS)

    def place(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes -> (owner, value within the owner's range)."""
        owner = ((fp >> np.uint64(32)) * np.uint64(self.owners)) >> np.uint64(32)
        low = fp * np.uint64(0x9E3779B97F4A7C15)  # the high bits of fp chose the owner
        return owner.astype(np.int64), (low >> np.uint64(64 - self.bits)).astype(np.int64)

    def messages(self, fp: np.ndarray):
        """Yields (owner, positions in ``fp`` in coded order, blob)."""
        owner, value = self.place(fp)
        order = np.lexsort((value, owner))
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            yield int(owner[part[0]]), part, counted_encode(value[part])


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """One owner: a bitmap for each message, 1 where the distinct value occurs again in
    any message of this owner (its own included)."""
    lists = [counted_decode(b) for b in group["blob"]]
    _, which, senders = np.unique(np.concatenate([x for x, _ in lists]), return_inverse=True, return_counts=True)
    again = np.split((senders > 1)[which], np.cumsum([len(x) for x, _ in lists])[:-1])
    maps = [np.packbits((counts > 1) | x).tobytes() for (_, counts), x in zip(lists, again)]
    return pd.DataFrame({"sender": group["sender"], "chunk": group["chunk"],
                         "owner": group["owner"], "bitmap": maps})


def duplicate_bitmaps(messages: DataFrame) -> DataFrame:
    """``messages(sender, chunk, owner, blob)``, written and so fixed, -> the
    owners' answers (sender, chunk, owner, bitmap). An owner's group is about
    PER_OWNER distinct values, those of several chunks once for each; only codes and bitmaps travel."""
    # A given number of partitions: codes are small, and owners packed by size would decode in a few tasks.
    return (messages.select("sender", "chunk", "owner", "blob")
            .repartition(shuffle_width(messages), "owner").groupBy("owner")
            .applyInPandas(_answer, "sender long, chunk long, owner long, bitmap binary"))


def with_bitmaps(messages: DataFrame, n: int) -> DataFrame:
    """The messages, payload included, each with its bitmap; ``n`` fingerprints in all. Answers of up
    to BROADCAST_BITS bits (16 MB) are broadcast, so that the payload stays where it is."""
    answers = duplicate_bitmaps(messages)
    if n <= BROADCAST_BITS:
        answers = F.broadcast(answers)
    return messages.join(answers, ["sender", "chunk", "owner"])


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


__all__ = ["Universe", "answered", "counted_decode", "counted_encode", "duplicate_bitmaps", "rice_decode",
           "rice_encode", "shuffle_width", "with_bitmaps"]
