"""Jaccard join, suffix-order dedup, archives and the pipeline against plain versions."""

import base64
import collections
import gzip
import hashlib
import io
import random
import re

import numpy as np

import public_tokenizers
import pytest

from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import corpus
from tests.llm.test_text import base_counts, fold, plain_matches
from tributary.llm import jaccard, quality_rules, suffix_dedup, warc
from tributary.llm.components import components


# ---- components and near copies ------------------------------------------------------------------------------------


def plain_components(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(k, k + 1) for k in range(40)] + [(rnd.randint(100, 160), rnd.randint(100, 160)) for _ in range(30)] + [(7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert found == {n: c for n, c in plain_components(links, nodes).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain_classes(texts):
    sets = {k: shingles(t) for k, t in texts}
    links = []
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
    return {k: (len(sets[k]), c) for k, c in plain_components(links, sets).items()}


def near_family(seed, n, words=80, changes=6):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, changes)):
            own[rnd.randrange(words)] = f"x{rnd.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [4096, 5])
def test_classes(table, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = [*corpus(11, n=80), *near_family(1, 25), *near_family(2, 12, words=11, changes=1), *near_family(3, 8, words=300, changes=9)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(table(*texts)).collect()}
    assert found == plain_classes(list(enumerate(texts)))


def test_ties_that_are_too_weak_are_found_by_the_second_filter(table, monkeypatch):
    monkeypatch.setattr(jaccard, "TIE", 1.1)  # no strong tie at all
    texts = [*near_family(4, 15), *corpus(12, n=20)]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(table(*texts)).collect()} == plain_classes(list(enumerate(texts)))


@pytest.mark.parametrize("n_shards, rows, tokens", [(1, 2048, 1 << 20), (7, 2, 1 << 20), (50, 3, 10)])
def test_counts_of_shared_shingles_are_those_of_all_pairs(monkeypatch, n_shards, rows, tokens):
    monkeypatch.setattr(jaccard, "_ROWS", rows)
    monkeypatch.setattr(jaccard, "_BATCH_TOKENS", tokens)
    rnd = random.Random(n_shards)
    pool = [rnd.getrandbits(64) for _ in range(60)]
    sets = {n: np.unique(np.array([rnd.choice(pool) if n % 3 else rnd.getrandbits(64) for _ in range(rnd.randint(1, 9))], np.uint64)) for n in range(-20, 20)}
    sets[99] = np.unique(np.array([rnd.getrandbits(64) for _ in range(3000)], np.uint64))  # more than a byte can count
    for labels in ({n: n for n in sets}, {n: n // 4 for n in sets}):
        shards = collections.defaultdict(list)
        for b in jaccard._batched(((n, labels[n], s) for n, s in sets.items()), n_shards):
            for k in range(b.num_rows):
                shards[b.column("shard")[k].as_py()].append(b.slice(k, 1))
        homes = collections.defaultdict(list)
        for blocks in shards.values():
            for b in jaccard._count(n_shards)(iter(blocks)):
                homes[b.column("shard")[0].as_py()].append(b)
        found = {n for blocks in homes.values() for b in jaccard._enough(iter(blocks)) for n in b.column("node").to_pylist()}
        others = lambda n: {t for m, s in sets.items() if labels[m] != labels[n] for t in s.tolist()}
        assert found == {n for n, s in sets.items() if 100 * len(others(n) & set(s.tolist())) >= 75 * len(s)}


def test_documents_that_share_nothing(table):
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "", None]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(table(*texts)).collect()} == {0: (2, 0), 1: (2, 1), 2: (0, 2), 3: (0, 3)}


def test_trie_links_are_those_of_all_pairs():
    rnd = random.Random(5)
    for _ in range(150):
        sets = [np.unique(np.array([rnd.randrange(12) for _ in range(rnd.randint(1, 12))], np.uint64)) for _ in range(rnd.randint(2, 9))]
        pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})]
        found = jaccard.cluster_links(list(range(len(sets))), sets)
        assert plain_components(found, range(len(sets))) == plain_components(pairs, range(len(sets)))


def test_one_of_each_keeps_rows_as_they_are(table):
    docs = table((5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, None), (4, None), (6, " "), (7, "other"), more=", component string, n long", value=None)
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(3, "a b c d e f"), (4, ""), (4, ""), (6, " "), (7, "other")]
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


# ---- repeated passages -----------------------------------------------------------------------------------------


def plain_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("batch", [1 << 15, 8])
def test_repeated_bytes(table, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    texts = [*corpus(13, n=50), *near_family(6, 12, words=200, changes=5), "ab" * 400, "x" * 1000, "é" * 300, "q" + "é" * 120, *corpus(13, n=3)]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(suffix_dedup.removed(table(*texts).repartition(3))).collect()}
    assert found == dict(enumerate(plain_removed(texts, 200)))


def test_repeats_of_rows_with_the_same_id(table):
    rnd = random.Random(7)
    a, b = ("".join(rnd.choice("abcdefgh ") for _ in range(300)) for _ in range(2))
    docs = table((1, a), (1, b + a), (None, b), (1, a), (2, None), (3, ""), more=", kept string, removed long", value=None)
    rows = suffix_dedup.report(suffix_dedup.removed(docs)).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows) == [(0, 300, 300), (1, 300, 300), (1, 300, 300), (1, 600, 600), (2, 0, 0), (3, 0, 0)]
    assert suffix_dedup.removed(docs.limit(0)).count() == 0


def test_clean_keeps_characters_whole(table):
    shared = "".join(chr(0x4E00 + k) for k in range(100))
    docs = table("a" + shared + "é", "b" + shared + "è", shared, "alone", None)
    out = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.clean(docs).collect()}
    assert out == {0: ("aé", 2), 1: ("bè", 2), 3: ("alone", 5), 4: (None, None)}


def test_columns_in_order_show_repeats():
    rnd = random.Random(8)
    for _ in range(60):
        n, width, length = rnd.randint(1, 10), rnd.randint(5, 12), rnd.randint(2, 5)
        m = np.array([[rnd.choice([97, 98, 99, suffix_dedup.OUTSIDE]) for _ in range(n)] for _ in range(width)], np.uint16)
        found = suffix_dedup.repeated_starts(m, length)
        for c in range(width - length + 1):
            for k in range(n):
                own = m[c : c + length, k]
                assert found[c, k] == ((own != suffix_dedup.OUTSIDE).all() and any((own == m[c : c + length, j]).all() for j in range(n) if j != k))


# ---- archives --------------------------------------------------------------------------------------------------------


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives(spark):
    pages = [(k, f"http://x/{k}", t) for k, t in enumerate(["<p>é</p>", "b" * 70000, "", None, "<p>é</p>", "c\r\n\r\nd", "WARC/1.1\r\n\r\n"])] + [(9, None, "<p>é</p>"), (8, "u", "once"), (8, "u", "once")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    files = warc.write(frame, warc_folder(spark), file_bytes=1000)
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read(files).collect())
    first = {}
    for page_id, _, text in pages:
        first[text or ""] = min(page_id, first.get(text or "", page_id))
    wanted = []
    for page_id, _, text in pages:
        data, own = (text or "").encode(), first[text or ""]
        wanted.append((page_id, len(data), sha1(text), "response" if own == page_id else "revisit", None if own == page_id else own, data if own == page_id else None))
    assert got == sorted(wanted)
    assert warc.read(warc.write(frame.limit(0), warc_folder(spark))).count() == 0


def warc_folder(spark):
    from tributary.session import staging_path

    return staging_path(spark, "warc")


def test_reader_wants_one_sound_record_a_member():
    one, two = warc.record(1, "u", b"abc", False, None), warc.record(2, "v", b"x" * 200000, False, None)
    found = list(warc.records(io.BytesIO(one + two)))
    assert [r.offset for r in found] == [0, len(one)] and warc.payload_of(found[1])[1] == 200000
    whole = gzip.decompress(one)
    for wrong in (one + two[:-9], gzip.compress(whole.replace(b"abc", b"abd")), gzip.compress(whole + whole), gzip.compress(whole[:-6]), gzip.compress(b"no record\r\n\r\n"), one + b"junk"):
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(wrong)))
    altered = gzip.compress(re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", whole).replace(b"abc", b"abd"))
    with pytest.raises(warc.WarcError, match="payload"):
        warc.payload_of(next(warc.records(io.BytesIO(altered))))


# ---- the pipeline -----------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    rnd = random.Random(14)
    texts = [t for t in [*corpus(15, n=70, words=160), *near_family(9, 10, words=150, changes=3)]]
    item = " ".join(f"q{rnd.randint(0, 99)}" for _ in range(14))
    texts += [" ".join(f"c{rnd.randint(0, 999)}" for _ in range(90)) + " " + item + f" end{k}" for k in range(3)]
    spark.createDataFrame([(k, t, "xx", "s", None if t is None else len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(0, len(texts), 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ratio = quality_rules.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet").where("quality = 1"))
    score = {r.doc_id: r.score for r in quality_rules.score(docs, ratio).collect()}
    left = {}
    for k, t in enumerate(texts):
        n, _, _, _, repeated = base_counts(t)
        if n >= 50 and 100 * repeated <= 50 * n and score[k] >= quality_rules.MIN_SCORE:
            left[k] = t
    left = {k: t for k, t in left.items() if plain_classes(list(left.items()))[k][1] == k}
    keys, data = list(left), [t.encode() for t in left.values()]
    seen = collections.Counter(d[k : k + 200] for d in data for k in range(len(d) - 199))
    for key, d in zip(keys, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - 199):
            if seen[d[k : k + 200]] > 1:
                gone[k : k + 200] = True
        text, at = "", 0
        for c in left[key]:
            size = len(c.encode())
            text += "" if gone[at : at + size].all() else c
            at += size
        left[key] = text
    left = {k: t for k, t in left.items() if re.search(r"[^\x20\x09-\x0D]", t)}
    hit = plain_matches(list(left.items()), [(1, item)], 10)
    left = {k: t.replace(item, "") if hit[k][4] else t for k, t in left.items() if 2 * hit[k][1] <= hit[k][0]}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {k: library.encode(t, add_special_tokens=False).ids for k, t in left.items()}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == wanted and 0 < len(got) < len(texts)
