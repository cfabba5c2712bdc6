import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelwise.functions import cleaning, dates, geo, keys, scoring, text


def values(rows, column):
    return [row[0] for row in rows.select(column).collect()]


def test_strip_keeps_inner_space_and_knows_unicode(frame):
    rows = frame("t string", (" a  b ",), (" x　",), ("\tq\n",), ("\x1cz\x1f",), (None,))
    assert values(rows, cleaning.strip_text(F.col("t"))) == ["a  b", "x", "q", "z", None]


def test_null_words(frame):
    rows = frame("t string", ("",), ("NULL",), ("NaN",), ("<NA>",), ("null",), ("01037",), (None,))
    assert values(rows, cleaning.null_words(F.col("t"))) == [None, None, None, None, "null", "01037", None]


@pytest.mark.parametrize(
    "written, expected",
    [("2.5", 2), ("3.5", 4), ("abc", None), ("", None), ("1d", None), (" 7 ", 7), ("-1.5", -2), ("1e2", 100), (None, None), ("NaN", None)],
)
def test_to_whole_rounds_half_to_even(frame, written, expected):
    assert values(frame("t string", (written,)), cleaning.to_whole(F.col("t"))) == [expected]


def test_to_real_and_to_stamp_tolerate_bad_input(frame):
    rows = frame("t string", ("abc",), ("1.25",), ("2017-10-02 10:56:33",))
    assert values(rows, cleaning.to_real(F.col("t"))) == [None, 1.25, None]
    assert values(rows, cleaning.to_stamp(F.col("t")))[2] == datetime(2017, 10, 2, 10, 56, 33)
    assert values(rows, cleaning.to_stamp(F.col("t")))[0] is None


def test_blank_text_is_null_and_breaks_become_one_space(frame):
    rows = frame("t string", (" ",), ("\n",), ("a\r\n\r\nb",), (" c\n",))
    assert values(rows, cleaning.null_if_blank(F.col("t"))) == [None, None, "a b", "c"]


@pytest.mark.parametrize(
    "title, message, kept, strict",
    [("t", "m", "t. m", "t. m"), ("t", None, "t", None), (None, "m", "m", None), (None, None, None, None)],
)
def test_join_text(frame, title, message, kept, strict):
    rows = frame("a string, b string", (title, message))
    assert values(rows, cleaning.join_text(F.col("a"), F.col("b"))) == [kept]
    assert values(rows, cleaning.join_text(F.col("a"), F.col("b"), strict=True)) == [strict]


def test_ratio_and_flag(frame):
    rows = frame("a int, b int", (1, 2), (1, 0), (None, 1))
    assert values(rows, cleaning.guarded_ratio(F.col("a"), F.col("b"))) == [0.5, None, None]
    pairs = frame("a string, b string", ("SP", "SP"), ("SP", None), (None, None), ("SP", "RJ"))
    assert values(pairs, cleaning.equality_flag(F.col("a"), F.col("b"))) == [1, 0, 0, 0]


def test_hours_count_clock_boundaries(frame):
    rows = frame(
        "a timestamp_ntz, b timestamp_ntz",
        (datetime(2017, 1, 1, 10, 59), datetime(2017, 1, 1, 11, 1)),
        (datetime(2017, 1, 1, 23, 59), datetime(2017, 1, 2, 0, 0)),
        (datetime(2017, 1, 1, 10, 0), datetime(2017, 1, 1, 10, 59)),
        (datetime(2017, 1, 2, 0, 0), datetime(2017, 1, 1, 23, 59)),
        (datetime(2017, 1, 2, 0, 0), None),
    )
    assert values(rows, dates.hours_between(F.col("a"), F.col("b"))) == [1, 1, 0, -1, None]
    assert values(rows, dates.days_between(F.col("a"), F.col("b"))) == [0, 1, 0, -1, None]


def test_weekday_starts_on_sunday(frame):
    rows = frame("d string", ("2017-01-01",), ("2017-01-02",), ("2017-01-07",)).select(F.col("d").cast("date").alias("d"))
    assert values(rows, dates.weekday(F.col("d"))) == [0, 1, 6]
    assert values(rows, dates.is_weekend(F.col("d"))) == [True, False, True]


def test_haversine(frame):
    rows = frame("a double, b double, c double, d double", (40.7127, -74.0059, 34.0500, -118.2500), (1.0, None, 2.0, 2.0), (0.0, 0.0, 0.0, 180.0))
    km = values(rows, geo.haversine_km(*[F.col(c) for c in "abcd"]))
    assert km[0] == pytest.approx(3936.385096389)
    assert km[1] is None
    assert km[2] == pytest.approx(20015.086796)


def test_surrogate_key_tells_null_from_text(frame):
    rows = frame("a string, b string", ("x", "y"), ("x", None), (None, "y"), ("x-y", ""))
    found = values(rows, keys.surrogate_key("a", "b"))
    assert len(set(found)) == 4
    assert found[0] == hashlib.md5(b"x-y").hexdigest()
    assert values(rows, keys.key_if_found(F.col("a"), "a"))[2] is None


@pytest.mark.parametrize(
    "body, words, caps, bang, label",
    [
        (None, 0, False, False, "sem_comentario"),
        ("Não recomendo", 2, False, False, "positivo"),
        ("10", 1, True, False, "neutro"),
        ("PÉSSIMO!", 1, True, True, "negativo"),
        ("ÓTIMO  produto", 2, False, False, "positivo"),
        ("gato por lebre", 3, False, False, "negativo"),
    ],
)
def test_text_features(frame, body, words, caps, bang, label):
    rows = frame("t string", (body,))
    column = F.col("t")
    assert values(rows, text.word_count(column)) == [words]
    assert values(rows, text.char_count(column)) == [len(body or "")]
    assert values(rows, text.all_caps(column)) == [caps]
    assert values(rows, text.has_exclamation(column)) == [bang]
    assert values(rows, text.keyword_sentiment(F.lower(column))) == [label]


def test_negation_first_reverses_the_order(frame):
    rows = frame("t string", ("não recomendo",), ("recomendo",))
    assert values(rows, text.keyword_sentiment(F.lower("t"), negation_first=True)) == ["negativo", "positivo"]


def test_score_labels_and_coherence(frame):
    rows = frame("s int", (5,), (4,), (3,), (2,), (1,), (None,))
    assert values(rows, text.score_sentiment(F.col("s"))) == ["positivo", "positivo", "neutro", "negativo", "negativo", "neutro"]
    pairs = frame(
        "a string, b string",
        ("positivo", "negativo"),
        ("negativo", "positivo"),
        ("positivo", "neutro"),
        ("neutro", "negativo"),
        ("positivo", "sem_comentario"),
    )
    expected = ["divergente", "divergente", "coerente", "coerente", "sem_texto"]
    assert values(pairs, text.coherence(F.col("a"), F.col("b"))) == expected


def test_scoring(frame):
    rows = frame("z double", (0.0,), (100.0,), (-100.0,))
    assert values(rows, scoring.sigmoid(F.col("z"))) == pytest.approx([0.5, 1.0, 0.0], abs=1e-12)
    assert values(rows, scoring.threshold_label(scoring.sigmoid(F.col("z")))) == ["late", "late", "on_time"]
    assert values(rows, scoring.standardise(F.col("z"), 0.0, 0.0)) == [0.0, 100.0, -100.0]


def test_packed_keys_are_equal_only_for_equal_keys(frame):
    texts = ["a" * 32, "A" * 32, "0" * 32, "0" * 31, "\0" * 16, "", "gone", "676f6e65", "g" * 32, None]
    rows = frame("n int, some_key string", *enumerate(texts))
    packed = [row.some_key for row in keys.packed(rows, "some_key").orderBy("n").collect()]
    assert packed[0] == b"\xaa" * 16 and packed[2] == bytes(16) and packed[-1] is None
    assert len(set(packed)) == len(texts)
    assert keys.packed(rows.withColumnRenamed("some_key", "some_id"), "some_id").dtypes[1] == ("some_id", "string")
