"""Secret scan: keyword prefilter, anchored expressions, checksums.

One Aho-Corasick pass over the ASCII-lower-cased text finds the keywords that
a secret must hold; an anchored regular expression is tried only where one
begins.  Runs of hexadecimal digits have no keyword: their anchors are the
bytes at every 16th place, of which a run of 32 covers two neighbours; only
there is a run widened to both sides.

Base kinds: ``assign`` (a named value of 8 characters or more), ``access``
(AKIA key ids) and ``hex`` (32 digits or more), leftmost and non-overlapping
per kind; a match that is too short still takes up its characters.  Further
kinds are kept only if their embedded checksum fits: ``github`` and ``npm``
tokens end in six base-62 digits of the CRC-32 of the 30 before them.

Defined results: a NULL or empty text has no spans; repeated rows are scanned
alike; NULL ids pass through; an empty table gives an empty result.  Spans
are in code points, the end exclusive.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import per_batch, undotted, without

# fixed values: what the base kinds match
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
BASE_KINDS = ("assign", "access", "hex")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
# fixed values: published token formats with a checksum
CHECKED = {"github": re.compile(r"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])"),
           "npm": re.compile(r"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])")}
CHECKED_WORDS = {"github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

KINDS = (*BASE_KINDS, *CHECKED)
_HEX = b"0123456789abcdef"
_HEX_RUN = re.compile(rb"[0-9a-f]+")
_IS_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def checksum62(body: str) -> str:
    """CRC-32 of the text as six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return digits


@cache
def _keywords():
    import ahocorasick
    found = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        found.add_word(word, ("assign", len(word)))
    found.add_word("akia", ("access", 4))
    for kind, words in CHECKED_WORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def hex_runs(raw: bytes) -> list[tuple[int, int]]:
    """Byte offsets of the runs of MIN_HEX digits or more."""
    gap = MIN_HEX // 2
    probes = _IS_HEX[np.frombuffer(raw, np.uint8)[::gap]]
    out, done = [], 0
    for at in (np.flatnonzero(probes[1:] & probes[:-1]) * gap).tolist():
        if at >= done:
            start = done + len(raw[done:at].rstrip(_HEX))
            done = _HEX_RUN.match(raw, at).end()
            if done - start >= MIN_HEX:
                out.append((start, done))
    return out


def spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, by start, then in the order of KINDS."""
    if not text:
        return []
    raw = text.encode()
    out, taken = [], dict.fromkeys(KINDS, 0)
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in _keywords().iter(raw.lower().decode()))
    for start, kind in hits:
        if start < taken[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, start)
            good = m and len(m[2]) >= MIN_VALUE
        elif kind == "access":
            m = ACCESS.match(text, start)
            good = m and len(m[0]) >= MIN_ACCESS
        else:
            m = CHECKED[kind].match(text, start)
            good = m and checksum62(m[0][4:34]) == m[0][34:]
        if m:
            taken[kind] = m.end()
        if good:
            out.append((start, kind, m.end()))
    seen = points = 0       # bytes and code points before the run
    for start, end in hex_runs(raw):
        points += len(raw[seen:start].decode())
        out.append((points, "hex", points + end - start))
        seen, points = end, points + end - start
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def scan(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end) in ``out_col``; an input
    column of that name is replaced."""
    docs, back = undotted(without(docs, out_col))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": a, "end": b} for a, k, b in spans(t.as_py())]
                 for t in batch.column(text_col)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, SPANS)],
                                          [*batch.schema.names, out_col])

    kind = StructType.fromDDL("spans array<struct<kind:string,start:int,end:int>>")["spans"].dataType
    schema = StructType(list(docs.schema.fields)).add(out_col, kind)
    return docs.mapInArrow(per_batch(one), schema).withColumnsRenamed(back)


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(found: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))
