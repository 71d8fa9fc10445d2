from __future__ import annotations

import random
import re

from deskmetrics.llm import queries, secrets

from . import brute
from .conftest import SF

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def plain(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(a, secrets.BASE_KINDS[k], b) for a, k, b in sorted(out)]


def base(text):
    return [s for s in secrets.spans(text) if s[1] in secrets.BASE_KINDS]


def test_base_spans_match_whole_text_scans():
    rnd = random.Random(1)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apiKey", "AKIA", "=", " ", ":", "'", '"', "abc12345",
             "0123456789abcdef", "f" * 31, "a" * 40, "é", "K", "ſecret", "\n", "xyz-_.", "ABCDEFGH12345678", "İ"]
    for _ in range(8000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert base(text) == plain(text), text


def test_hex_runs_are_tried_at_anchors_only(monkeypatch):
    tried = []

    class Spy:
        def match(self, raw, at):
            tried.append(at)
            return pattern.match(raw, at)
    pattern = secrets._HEX_RUN
    monkeypatch.setattr(secrets, "_HEX_RUN", Spy())
    rnd = random.Random(7)
    for _ in range(3000):
        text = "".join(rnd.choice(["a" * rnd.randint(1, 40), "z", "é", " the ", "0f" * rnd.randint(1, 20)]) for _ in range(9))
        tried.clear()
        assert [s for s in secrets.spans(text) if s[1] == "hex"] == [s for s in plain(text) if s[1] == "hex"], text
        raw = text.encode()
        assert len(tried) <= len(raw) // 16 and all(raw[i:i + 1] in secrets._HEX and raw[i + 16:i + 17] in secrets._HEX
                                                   for i in tried)


def test_checksums_decide_further_kinds():
    body = "abcdefghijABCDEFGHIJ0123456789"
    good = "ghp_" + body + secrets.checksum62(body)
    wrong = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert secrets.spans(f"é {good} x") == [(2, "github", 42)]
    assert secrets.spans(f"{wrong} {good}x") == []
    assert secrets.spans("npm_" + good[4:]) == [(0, "npm", 40)]


def test_query_matches_brute_force(spark, sf_texts):
    for r in queries.op5_secret_scan(spark, SF).collect():
        found = plain(sf_texts[r.doc_id] or "")
        kinds = [k for _, k, _ in found]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(kinds.count, secrets.BASE_KINDS))
        assert r.base_sha256 == brute.sha(",".join(f"{k}:{a}:{b}" for a, k, b in found))


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    assert [r.spans for r in secrets.scan(edge_docs).collect()] == [[]] * len(edge_rows)
    out = secrets.scan(clashing_docs)
    assert out.columns.count("spans") == 1 and out.count() == len(edge_rows)
    assert secrets.scan(no_docs).collect() == []
