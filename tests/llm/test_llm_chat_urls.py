"""Event log folding, rendering and URL rules."""

import hashlib

import pytest

from parcelwise.llm import chat, urls

EVENTS = "conv_id long, seq long, message_id string, kind string, role string, text string, extra int"


def messages(spark, *rows, schema=EVENTS):
    found = chat.fold(spark.createDataFrame([(*r, 0) for r in rows], schema)).orderBy("conv_id", "seq").collect()
    return [(r.conv_id, r.message_id, r.role, r.text) for r in found]


def test_deltas_edits_and_regenerations(spark):
    found = messages(
        spark,
        (1, 0, "u", "start", "user", None),
        (1, 1, "u", "delta", None, "Helo"),
        (1, 2, "a", "start", "assistant", None),
        (1, 3, "a", "delta", None, "wrong "),
        (1, 4, "a", "delta", None, "answer"),
        (1, 5, "a", "regenerate", None, None),
        (1, 7, "a", "delta", None, "answer"),
        (1, 6, "a", "delta", None, "right "),
        (1, 8, "u", "edit", None, "Hello"),
        (1, 9, "x", "start", "user", None),
        (1, 10, "x", "delta", None, "gone"),
        (1, 11, "x", "delete", None, None),
        (1, 12, "x", "delta", None, "late"),
    )
    assert found == [(1, "u", "user", "Hello"), (1, "a", "assistant", "right answer")]


def test_odd_events(spark):
    assert messages(
        spark,
        (None, None, None, "delta", None, None),
        (2, 1, "m", "unknown", "user", "x"),
        (3, 1, "m", "delta", "user", "without start"),
        (4, 1, "m", "delete", None, None),
        (4, 2, "m", "edit", None, "back"),
        (5, 1, "m", "start", None, None),
        (5, 2, "m", "delta", None, "twice"),
        (5, 2, "m", "delta", None, "twice"),
    ) == [(None, None, "", ""), (3, "m", "", "without start"), (4, "m", "", "back"), (5, "m", "", "twicetwice")]
    assert messages(spark) == []


TEXTS = ["", "\\", "\\-", "<|end|>\n", "a<s>b</s>[INST] x [/INST]<<SYS>>\\n", "<<s>", "<|<|", "\n\n", "é日\x00", None, "x" * 300_000]


def test_rendering_can_be_read_back(spark):
    rows = [(1, k, role, text) for k, (role, text) in enumerate((r, t) for t in TEXTS for r in ("user", "assistant", "od\nd\\n<|"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat.format_log(chat.rows_as_events(turns)).orderBy("seq").collect()
    assert [chat.parse(r.segment) for r in segments] == [(role, text or "") for _, _, role, text in rows]
    for r in segments:
        inside = r.segment.removeprefix(chat.TURN).removesuffix(chat.END)
        assert not any(c in inside for c in chat.CONTROLS)
        masked = r.segment[r.loss_start : r.loss_start + r.loss_length]
        role, text = chat.parse(r.segment)
        assert chat.unescape(masked) == (text if role == "assistant" else "")


def test_read_back_digests_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_log(chat.rows_as_events(turns))).collect()}
    digest = hashlib.sha256(b"user\na\nuser\nb\nassistant\nx\nassistant\nx\n").hexdigest()
    assert (found[1].n_turns, found[1].turns_sha256, found[1].loss_chars) == (4, digest, 2)
    assert found[1].loss_sha256 == hashlib.sha256(b"xx").hexdigest()
    assert found[None].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert chat.read_back(chat.format_log(chat.rows_as_events(turns.limit(0)))).collect() == []


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("EXAMPLE.com", "/pre", "block"),
    ("both.org", "", "allow"),
    ("both.org", "", "block"),
    ("", "/", "block"),
    (None, "/", "block"),
    ("x.org", None, "block"),
    ("x.org", "/a/", "other"),
]


@pytest.mark.parametrize("few", [100_000, 0])
def test_rules_and_precedence(spark, monkeypatch, few):
    monkeypatch.setattr(urls, "BROADCAST_RULES", few)
    cases = {
        "http://example.com/en/x": ("example.com/en/", "block"),
        "HTTP://A.B.Example.com/en/?q=/fr/": ("example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com/en/", "allow"),
        "https://www.example.com/en": ("com/", "allow"),
        "https://notexample.com/en/": ("com/", "allow"),
        "https://example.com/prefix#x": ("example.com/pre", "block"),
        "https://example.com": (None, "allow"),
        "https://com/": ("com/", "allow"),
        "http://sub.both.org?x": ("both.org", "block"),
        "http://x.org/a/b": ("x.org", "block"),
        "no scheme": (None, "allow"),
        "": (None, "allow"),
        None: (None, "allow"),
        "http://": (None, "allow"),
        "http://" + "a." * 5000 + "com/" + "d/" * 50_000: ("com/", "allow"),
    }
    rows = [(k, u, "old") for k, u in enumerate(cases)] * 2
    frame = spark.createDataFrame(rows, "id int, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = urls.judge(frame, rules).collect()
    assert len(found) == len(rows)
    assert {r.url: (r.rule, r.verdict) for r in found} == cases
    assert {r.host for r in found if r.id == 1} == {"a.b.example.com"}
    assert urls.judge(frame.limit(0), rules).collect() == []
    assert {r.verdict for r in urls.judge(frame, rules.limit(0), default="block").collect()} == {"block"}
