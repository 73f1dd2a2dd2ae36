"""Networks as disjoint ranges: nested and overlapping networks are flattened once, so that each address is in one range
at most and is found by one binary search.

The flat ranges of lists of up to ``MOST_NETWORKS`` networks together (some 100 MB in a task) are broadcast; an address
then costs one search and no shuffle. Longer lists aren't flattened (None): ``address.address_dimension`` joins those by hash.
"""

from __future__ import annotations

import heapq
import re
import socket
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_NETWORKS = 1_000_000


@dataclass
class Ranges:
    """First addresses of ranges in order, as 16 bytes, and what holds from each on (None: no network)."""

    bounds: np.ndarray
    winners: list

    def find(self, addresses: np.ndarray) -> list:
        places = np.searchsorted(self.bounds, addresses, "right") - 1
        return [self.winners[p] if p >= 0 else None for p in places.tolist()]


def flatten(networks: list[tuple[int, int, tuple]], largest: bool) -> Ranges:
    """``networks``: (first, last, key) with overlaps; of those that hold an address the one with the largest or smallest key
    wins. A sweep over their ends keeps the open ones in a heap by the rank of their keys."""
    ranks = {k: i for i, k in enumerate(sorted({k for _, _, k in networks}, key=lambda k: [(x is not None, x) for x in k], reverse=largest))}
    opened = sorted((first, last, ranks[k], k) for first, last, k in networks)
    points = sorted({x for first, last, _ in networks for x in (first, last + 1)})
    at, active, bounds, winners = 0, [], [], []
    for p in points:
        while at < len(opened) and opened[at][0] == p:
            heapq.heappush(active, (opened[at][2], opened[at][1], opened[at][3]))
            at += 1
        while active and active[0][1] < p:
            heapq.heappop(active)
        now = active[0][2] if active else None
        if p < 1 << 128 and (not winners or winners[-1] != now):
            bounds.append(p.to_bytes(16, "big"))
            winners.append(now)
    return Ranges(np.array(bounds, dtype="S16"), winners)


def packed(address: str | None) -> tuple[int, bytes] | None:
    """Version and 16 bytes of an address; None if it is none."""
    if address is None:
        return None
    version = 6 if ":" in address else 4
    try:
        return version, socket.inet_pton(socket.AF_INET6 if version == 6 else socket.AF_INET, address).rjust(16, b"\0")
    except (OSError, UnicodeEncodeError, ValueError):
        return None


def network(cidr: str | None) -> tuple[int, int, int, int] | None:
    """Version, first and last address and prefix length of addr/len; None if it isn't one."""
    address, slash, size = (cidr or "").partition("/")
    if not slash or "/" in size or (found := packed(address)) is None or not re.fullmatch(r"\s*[+-]?[0-9]{1,9}\s*", size):
        return None
    bits, plen = (32 if found[0] == 4 else 128), int(size)
    if not 0 <= plen <= bits:
        return None
    free = (1 << bits - plen) - 1
    first = int.from_bytes(found[1], "big") & ~free
    return found[0], first, first | free, plen


def _unsigned(hi: np.ndarray, lo: np.ndarray) -> list[int]:
    return [h << 64 | x for h, x in zip(hi.astype(np.uint64).tolist(), lo.astype(np.uint64).tolist())]


def lookup(enrichments: list) -> Callable[[str], Column] | None:
    """A function from an address column to a struct of the enrichments' columns; None where the lists are too long. Lists
    are normalised (``address.normalise``) or just have ``cidr``."""
    lists: list[DataFrame] = []
    for e in enrichments:
        if not any(e.networks is n for n in lists):
            lists.append(e.networks)
    left, flat = MOST_NETWORKS, {}
    for n in lists:
        own = [e for e in enrichments if e.networks is n]
        fields = [c for c in dict.fromkeys(c for e in own for c in (e.value, e.by)) if c in n.columns]
        where = ("version", "hi", "lo", "last_hi", "last_lo") if "hi" in n.columns else ("cidr",)
        rows = n.select(*where, *[F.col(c).alias(f"_{c}") for c in fields]).limit(left + 1).toArrow()
        left -= rows.num_rows
        if left < 0:
            return None
        if "hi" in n.columns:
            ends = rows.select(where).to_pandas()
            nets = list(zip(ends["version"].tolist(), _unsigned(ends["hi"].to_numpy(), ends["lo"].to_numpy()), _unsigned(ends["last_hi"].to_numpy(), ends["last_lo"].to_numpy())))
        else:
            nets = [network(c) for c in rows.column("cidr").to_pylist()]
        columns = {c: rows.column(f"_{c}").to_pylist() for c in fields} | ({} if "hi" in n.columns else {"plen": [None if x is None else x[3] for x in nets]})
        for e in own:
            keys = list(zip(columns[e.by], columns[e.value]))
            for version in (4, 6):
                some = [(x[1], x[2], k) for x, k in zip(nets, keys) if x is not None and x[0] == version]
                if version == 4 and not e.inclusive:
                    some = [(a + 1, b - 1, k) for a, b, k in some if a + 1 <= b - 1]
                flat[e.column, version] = flatten(some, e.largest)
    names = [e.column for e in enrichments]
    shared = lists[0].sparkSession.sparkContext.broadcast(flat)

    @F.pandas_udf(", ".join(f"{c} string" for c in names))
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for addresses in batches:
            codes, known = pd.factorize(addresses)
            parsed = [packed(a) for a in known]
            out = {c: np.full(len(known) + 1, None, dtype=object) for c in names}  # the last place is for null
            for version in (4, 6):
                own = [i for i, p in enumerate(parsed) if p is not None and p[0] == version]
                keys = np.array([parsed[i][1] for i in own], dtype="S16")
                for c in names:
                    out[c][own] = [None if k is None else k[1] for k in shared.value[c, version].find(keys)]
            yield pd.DataFrame({c: x[codes] for c, x in out.items()}, columns=names)

    return lambda address: found(F.col(address))
