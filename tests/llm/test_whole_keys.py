"""A private key is found and redacted from its BEGIN line to its END line."""

from __future__ import annotations

import random
import re
import string

import pytest

from reviewlake.llm import secrets

RULE = next(rule for rule in secrets.RULES if rule.kind == "pem")
_RNG = random.Random(4)
_CHARS = string.ascii_letters + string.digits + "+/"
LINES = ["".join(_RNG.choice(_CHARS) for _ in range(64)) for _ in range(300)] + ["Ab9+kQ=="]
BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
INFO = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011AAFF\n"


def _key(end: str = END, join: str = "\n", info: str = "") -> str:
    return join.join([BEGIN, *([info] if info else []), *LINES, *([end] if end else [])])


CASES = [
    ("before é\n", _key(), "\nafter it"),
    ("", _key(info=INFO), ""),
    ("x ", _key(join="\r\n"), "\r\n-----\r\nafter it"),
    ('{"key": "', _key(join="\\n"), '\\n", "b": 1}'),
    ("", _key(join=" "), " after it"),
    ("cut\n", _key(end=""), "\nplain words follow here"),
    ("cut\n", _key(end="", info=INFO), ""),
    ('{"key": "', _key(end="", join="\\n"), '", "b": 1}'),
    ("cut\n", _key(end=""), "\n" + BEGIN.replace("RSA", "EC")[:20] + " more"),
    ("", BEGIN, " is a header only, words follow."),
]


@pytest.mark.parametrize("head,key,tail", CASES)
def test_span(head, key, tail):
    found = [m.span() for m in re.finditer(RULE.pattern, head + key + tail)]
    assert found == [(len(head), len(head) + len(key))]


def test_redaction(spark):
    rows = [(i, "".join(case)) for i, case in enumerate(CASES)] + [(99, f"{_key()}\nbetween the keys\n{_key()}")]
    found = {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wanted = {i: f"{head}[secret]{tail}" for i, (head, _, tail) in enumerate(CASES)}
    assert found == wanted | {99: "[secret]\nbetween the keys\n[secret]"}
    assert RULE.version > 1
