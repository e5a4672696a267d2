import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

from feedloom.llm.queries import op8_secrets
from feedloom.llm.secrets import KINDS, candidates, find_secrets, live_looking, mask, without_secrets

from .conftest import docs_of, odd_rows

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def hex_of(seed, n=40):
    return hashlib.sha256(str(seed).encode()).hexdigest()[:n]


def rows():
    rng = random.Random(2)
    shared, rare = "Zx9" + hex_of("shared").upper(), "Qk7+" + "Z".join(re.findall(".{8}", hex_of("rare"))).upper()
    out = odd_rows()
    for n in range(300, 340):
        parts = [
            f'password: "{hex_of(n, 12)}"', "AKIA" + hex_of(n, 16).upper(), "AKIA" + hex_of(n, 10).upper(), hex_of(n, 23),
            hex_of(n, 24), "TOKEN='ab' api_key = x.y=z+1", "secret=token:abcdefgh", "ſecret=abcdefgh", "été token = \t x",
            "AKIAAKIA" + "B" * 20, "Secret:   " + hex_of(n), shared,
        ]
        rng.shuffle(parts)
        out.append((n, "\n".join(parts[:rng.randint(0, 12)]), "en", f"owner{n % 4}"))
    return out + [(400, f"a {rare} b", "en", "owner1"), (401, f"{rare.lower()}", "en", "owner1"), (402, "u" * 300 + "1", "en", None)]


def test_spans(spark):
    data = rows()
    texts = {i: t or "" for i, t, _, _ in data}
    held = defaultdict(set)
    for i, t, _, owner in set(data):
        for a, b, kind, value in candidates(t or ""):
            held[value].add(owner or "")
    got = find_secrets(docs_of(spark, data)).collect()
    assert Counter(r.id for r in got) == Counter(i for i, _, _, _ in data)
    for r in got:
        text = texts[r.id]
        assert [(s.start, s.kind, s.end) for s in r.spans if s.kind < 3] == base(text)
        extra = [text[s.start:s.end] for s in r.spans if s.kind == 3]
        expected = [text[a:b] for a, b, kind, value in candidates(text) if kind == 3 and len(held[value]) <= 2]
        assert extra == expected
    by_id = {r.id: r for r in got}
    assert len(by_id[400].spans) == 1 and by_id[400].spans[0].owned and by_id[400].spans[0].repositories == 2
    assert not any(text.startswith("Zx9") for r in got for text in [texts[r.id][s.start:s.end] for s in r.spans])


def test_stage_masks_findings_and_nothing_else(spark):
    data = rows()
    found = {r.id: [(s.start, s.end) for s in r.spans] for r in find_secrets(docs_of(spark, data)).collect()}
    kept = without_secrets(docs_of(spark, data), length_col="n_chars").collect()
    assert len(kept) == len(data)
    texts = {i: t for i, t, _, _ in data}
    for r in kept:
        text = texts[r.doc_id]
        assert r.text == (mask(text, found[r.doc_id], "[SECRET]") if text is not None else None)
        assert r.n_chars == (None if r.text is None else len(r.text)) and (r.id, r.row) == ("x", "y")
        assert not base(r.text or "")


def test_mask_joins_overlaps():
    assert mask("abcdefgh", [(1, 3), (2, 4), (6, 7)], "*") == "a*ef*h"
    assert mask("abc", [], "*") == "abc" and mask("abc", [(0, 3)], "*") == "*"


def test_looks():
    assert live_looking("a8Fk2LmQ9zXw4Rt7Yb1c") and not live_looking("abcdefghijklmnopqrstuvwxyz")
    assert not live_looking("1111111111111111111a") and not live_looking("12345678901234567890")


def test_empty(none):
    assert find_secrets(none).collect() == [] and without_secrets(none).collect() == []


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op8_secrets(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in spans) for kind in range(3))
        listed = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("owned")] == listed


def test_long_values_and_values_around_a_base_finding(spark):
    key = base64.b64encode(b"".join(hashlib.sha256(bytes([n])).digest() for n in range(30))).decode()
    payload = key[:700].replace("+", "-").replace("/", "_")
    around = "Zq7Xw9Kt_" + hex_of("inner", 24) + "_Rv8Mz2Pq"
    rows = [(1, f"x {key} y", "en", "a"), (2, f"ey.{payload}.Sig", "en", "a"), (3, f"x {around} y", "en", "b"), (4, f"token={hex_of(4)}", "en", "b")]
    found = {r.id: [(KINDS[s.kind], s.start, s.end) for s in r.spans] for r in find_secrets(docs_of(spark, rows)).collect()}
    assert found[1] == [("owned", 2, 2 + len(key))] and found[2] == [("owned", 3, 703)]
    assert ("owned", 2, 2 + len(around)) in found[3] and ("hex", 11, 35) in found[3]
    assert {kind for kind, _, _ in found[4]} == {"assign", "hex"}
    texts = {r.doc_id: r.text for r in without_secrets(docs_of(spark, rows)).collect()}
    assert texts == {1: "x [SECRET] y", 2: "ey.[SECRET].Sig", 3: "x [SECRET] y", 4: "[SECRET]"}


def test_owners_and_repositories_decide(spark):
    """One owner's key in many documents is a key; what two owners have in many is an example, in few it is theirs."""
    keys = {name: "Zq7" + base64.b64encode(hashlib.sha256(name.encode()).digest()).decode()[:20].replace("+", "x").replace("/", "y") + "9aB"
            for name in ("one", "few", "many", "wide")}
    rows = [(n, f"x {keys['one']} y", "en", "a") for n in range(40)]
    rows += [(100 + n, f"x {keys['few']} y", "en", "ab"[n % 2]) for n in range(20)]
    rows += [(200 + n, f"x {keys['many']} y", "en", "ab"[n % 2]) for n in range(21)]
    rows += [(300 + n, f"x {keys['wide']} y", "en", "abc"[n]) for n in range(3)]
    got = {r.id: r.spans for r in find_secrets(docs_of(spark, rows)).collect()}
    assert {i // 100 for i, spans in got.items() if spans} == {0, 1} and all(len(got[i]) == 1 for i in [*range(40), *range(100, 120)])
    assert got[0][0].repositories == 40 and got[100][0].owners == 2
    texts = {r.doc_id: r.text for r in without_secrets(docs_of(spark, rows)).collect()}
    assert all((text == "x [SECRET] y") == bool(got[i]) for i, text in texts.items())
    wide = find_secrets(docs_of(spark, rows), max_owners=3, max_repositories=2).collect()
    assert {r.id // 100 for r in wide if r.spans} == {0}
