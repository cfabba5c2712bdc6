"""The Merkle manifest, phrase collocations and byte-level BPE against plain versions."""

import base64
import collections
import hashlib
import random
import re
import zlib

import pytest
from plain import LOWERED, ODD
from pyspark.sql import functions as F

from parcelwise.llm import bpe_fold, collocations, merkle
from parcelwise.llm.queries import tokenizer_file
from parcelwise.llm.scratch import Scratch


@pytest.fixture
def scratch(spark):
    with Scratch(spark) as own:
        yield own


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + 16])) for k in range(0, len(last), 16)])
    return levels


def plain_climb(levels, at):
    """Siblings on both sides, level by level."""
    steps = []
    for level in levels[:-1]:
        run = at // 16 * 16
        steps.append(("".join(level[run:at]), "".join(level[at + 1 : run + 16])))
        at //= 16
    return steps


def plain_manifest(docs):
    """docs: (doc_id, text, lang, source, n_chars)."""
    sources = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in docs:
        sources[source].append((doc_id, plain_leaf(doc_id, source, lang, n_chars, text)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(sources[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[source] = own, plain_levels([leaf for _, leaf in own])
    top = plain_levels([trees[s][1][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        own, levels = trees[source]
        for at, (doc_id, leaf) in enumerate(own):
            steps = plain_climb(levels, at) + plain_climb(top, k)
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], steps))
    return out


def some_documents(sizes):
    docs, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            docs.append((n * 7 % 10_007, f"Text {n}" if n % 9 else None, None if n % 5 == 0 else "en", source, n if n % 4 else None))
            n += 1
    random.Random(1).shuffle(docs)
    return docs


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {"a": 16}, {"a": 17, None: 3, "Ä": 1, "b": 257}, {"hot": 4200, **{f"s{k}": 1 + k % 3 for k in range(40)}}],
    ids=["leaf", "run", "mixed", "hot"],
)
def test_manifest(spark, scratch, sizes):
    docs = some_documents(sizes)
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCUMENTS + ", digest string, tree int")
    found = merkle.manifest(frame.repartition(5), F.col("text"), scratch).collect()
    expected = plain_manifest(docs)
    rows = [(r.doc_id, r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.steps]) for r in found]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert all(r.current == r.leaf for r in found)


def test_manifest_of_odd_rows(spark, scratch):
    docs = [(i, t, None, None, None) for i, t in ODD]
    found = merkle.manifest(spark.createDataFrame(docs, DOCUMENTS), F.col("text"), scratch).collect()
    assert sorted((r.doc_id or -1, r.leaf, r.root) for r in found) == sorted((d or -1, leaf, root) for d, leaf, _, root, _ in plain_manifest(docs))
    assert merkle.manifest(spark.createDataFrame([], DOCUMENTS), F.col("text"), scratch).collect() == []


def test_a_changed_text_is_found(spark, scratch):
    docs = [(k, f"text {k}", "en", "s", 1) for k in range(300)]
    changed = F.when(F.col("doc_id") % 50 == 0, F.lit("other")).otherwise(F.col("text"))
    found = merkle.manifest(spark.createDataFrame(docs, DOCUMENTS), changed, scratch)
    root = merkle.folded(F.col("current"), F.col("steps"))
    bad = {r.doc_id for r in found.where(root != F.col("root")).collect()}
    assert bad == set(range(0, 300, 50))
    proof = found.where("doc_id = 17").select(merkle.proof_text(F.col("steps")).alias("p")).first().p
    assert len(proof) == 64 * (15 + 15 + 1)


# Phrase collocations


def plain_phrases(docs, least):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWERED)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for k in range(len(words) - size + 1):
                    counts[lang][tuple(words[k : k + size])] += 1
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            longer = [
                b for q, b in candidates.items() if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= 80 * a for b in longer):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            out.add((lang, " ".join(p), a, left, right, totals[lang], score))
    return out


def random_texts(seed, n):
    pick = random.Random(seed)
    words = ["der", "die", "New", "york", "times", "a", "ß", "日本", "of", "The"] + [f"w{k}" for k in range(40)]
    out = []
    for k in range(n):
        parts = []
        for _ in range(pick.randrange(60)):
            parts.append(pick.choice(["New York Times", "the a of", pick.choice(words), words[int(pick.random() ** 3 * len(words))]]))
            parts.append(pick.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  "]))
        out.append(("".join(parts), pick.choice(["en", "en", "de", None])))
    return out + [(None, "en"), ("", None), ("  \t ", "xx"), ("...", "en")]


def mined(spark, docs, monkeypatch, scratch, **small):
    for name, value in small.items():
        monkeypatch.setattr(collocations, name, value)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "text string, lang string, chunk int, words string")
    rows = collocations.mine(frame.repartition(3), scratch)
    assert rows.columns == ["lang", "phrase", "a", "l", "r", "n", "score"]
    return rows


@pytest.mark.parametrize(
    "small", [{}, {"BAND_MASS": 50, "CHUNK_WORDS": 200, "FAN_IN": 2}, {"BAND_MASS": 1, "CHUNK_WORDS": 5000, "FAN_IN": 3}], ids=["large", "small", "single"]
)
def test_collocations(spark, scratch, monkeypatch, small):
    docs = random_texts(3, 250)
    found = [tuple(r) for r in mined(spark, docs, monkeypatch, scratch, **small).collect()]
    expected = plain_phrases(docs, 30)
    assert len(found) == len(set(found)) == len(expected) > 30
    assert set(found) == expected


def test_collocations_of_one_hot_phrase(spark, scratch, monkeypatch):
    docs = [("go " * 500 + "stop", "en")] * 8 + [("a b c d e", None)] * 31 + random_texts(5, 20)
    found = {tuple(r) for r in mined(spark, docs, monkeypatch, scratch, BAND_MASS=64, CHUNK_WORDS=300, FAN_IN=2).collect()}
    assert found == plain_phrases(docs, 30)
    ranked = collocations.first(spark.createDataFrame(sorted(found), "lang string, phrase string, a long, l long, r long, n long, score long"), 3)
    for lang in {f[0] for f in found}:
        best = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))[:3]
        own = ranked.where(F.col("lang") == lang).orderBy("rank").collect()
        assert [(r["rank"], r.phrase) for r in own] == [(k + 1, f[1]) for k, f in enumerate(best)]


def test_collocations_of_odd_rows(spark, scratch, monkeypatch):
    docs = [(t, None) for _, t in ODD] + [("é " * 70_000 + "x, " * 400_000 + "end", "fr"), ("y" * 3_000_000 + " z", "fr")]
    found = {tuple(r) for r in mined(spark, docs, monkeypatch, scratch).collect()}
    assert found == plain_phrases(docs, 30)
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.mine(empty, scratch).collect() == []


# Byte-level BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, public_tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, scratch, library, monkeypatch):
    path, pattern, plain = library
    pick = random.Random(2)
    letters = "etaoins ETÄöß日本語한국어 ١٢½ 12,.!'\n\t  =_-🙂\x00\x85\xa0"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(200))) for _ in range(150)]
    texts += ["I'll we're <|endoftext|> don't", "word " * 3000, "".join(pick.choice("etaoinshr") for _ in range(3000)), "=" * 2000 + " " * 999]
    docs = [*enumerate(texts), *[(i, t) for i, t in ODD]]
    monkeypatch.setattr(bpe_fold, "CHUNK_WORDS", 2000)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, chunk int, words string")
    with_ids = bpe_fold.encode(scratch.stored(frame, "docs"), path, pattern)
    found = with_ids.select("doc_id", "ids", bpe_fold.decode(F.col("ids"), path).alias("bytes")).collect()
    expected = [(i, plain.encode_ordinary(t or ""), (t or "").encode()) for i, t in docs]
    assert sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in found), key=str) == sorted(expected, key=str)


def test_fold_and_heap_agree(spark, library):
    path, _, _ = library
    ranks, pick = bpe_fold.ranks_of(path), random.Random(4)
    words = ["".join(pick.choice("abcdeé日 ") for _ in range(pick.randrange(1, 90))) for _ in range(200)]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    chars = F.decode(F.col("word").cast("binary"), "ISO-8859-1")
    folded = {r.word: list(r.ids) for r in frame.select("word", bpe_fold.fold(chars, bpe_fold.rank_table(ranks)).alias("ids")).collect()}
    for word in words:
        assert bpe_fold.merge_by_heap(word.encode().decode("latin-1"), ranks) == folded[word]


def test_fold_of_long_words(spark, library):
    path, _, _ = library
    ranks, pick = bpe_fold.ranks_of(path), random.Random(5)
    words = ["".join(pick.choice("etaoin") for _ in range(n)) for n in (1, 2, 99, 100, 101, 102, 600, bpe_fold.FOLD_BYTES)]
    words += ["=" * bpe_fold.FOLD_BYTES, "\xff" * 3]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    folded = {r.word: list(r.ids) for r in frame.select("word", bpe_fold.fold(F.col("word"), bpe_fold.rank_table(ranks)).alias("ids")).collect()}
    assert folded == {word: bpe_fold.merge_by_heap(word, ranks) for word in words}


def test_the_fold_copies_no_state(spark, library):
    # a value bound by a transform over one element is copied, once for each binding and step
    frame = spark.createDataFrame([("word",)], "word string")
    folded = frame.select(bpe_fold.fold(F.col("word"), bpe_fold.rank_table({"w": 0, "o": 1, "r": 2, "d": 3})))
    assert "transform(array(" not in folded._jdf.queryExecution().optimizedPlan().toString()


def test_byte_bpe_of_nothing(spark, scratch, library):
    path, pattern, _ = library
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_fold.encode(scratch.stored(empty, "docs"), path, pattern).collect() == []


def test_scratch_goes_but_results_stay(spark):
    with Scratch(spark) as own:
        table = own.stored(spark.range(3), "x")
        kept = own.result(table, "kept")
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(own.paths[0] if own.paths else table.inputFiles()[0]).count()


def test_checksums_are_those_of_the_contract(spark):
    assert spark.sql("select crc32(cast(cast(1234 as string) as binary)) c").first().c == zlib.crc32(b"1234")
