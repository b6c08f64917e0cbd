"""Each query against its SQL or a brute-force version on the given tables."""

import base64
import hashlib
import os
import re
import struct

import public_tokenizers
import pytest
import tiktoken
from compare import connect, differences

from sharefold.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(SF_DIR), QUERIES[name], SQL[name], SF_DIR)[0] == ""


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c))
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    found = []
    for n, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),  # noqa: B023
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }
            if fine[kind]():
                found.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_pii(spark, texts):
    rows = QUERIES["op5_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in PII]
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_licenses(spark, texts):
    phrases = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
    for r in QUERIES["op4_license_scan"](spark, SF_DIR).collect():
        lower = texts[r.doc_id].translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, k) for k, p in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({k for _, k in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


SECRET = {
    "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""",
    "access": r"(?P<v>AKIA[A-Z0-9]+)",
    "hex": r"(?P<v>[0-9a-f]+)",
}


def test_secrets(spark, texts):
    least = {"assign": 8, "access": 16, "hex": 32}
    rows = QUERIES["op10_secret_scan"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = []
        for n, (kind, pattern) in enumerate(SECRET.items()):
            found += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, texts[r.doc_id]) if len(m["v"]) >= least[kind]]
        base = [s for _, _, s in sorted(found)]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k in SECRET]
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_conversations(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    said = "\\### Assistant: </turn> ok"
    turns = [(r.conv_id, r.turn, r.role, r.text or "") for r in rows] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    want = {}
    for conv, _, role, text in sorted(turns):
        want.setdefault(conv, []).append((role, text))
    found = {r.conv_id: r for r in QUERIES["op7_chat_format"](spark, SF_DIR).collect()}
    assert set(found) == set(want)
    for conv, own in want.items():
        r, spoken = found[conv], "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(spoken)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert r.formatted_chars > sum(len(t) for _, t in own)


def test_byte_bpe(spark, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = QUERIES["op6_byte_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = other.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
