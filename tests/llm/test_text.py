"""Quality rules, decontamination, encoding, counts, classifier and scoring against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import corpus
from tributary.llm import bpe, classifier, common, decontaminate, mixing_lm, quality_rules, suffix_dedup, token_counts, token_files

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- bytes and words ----------------------------------------------------------------------------------------


def test_word_spans_stay_in_their_rows():
    data, at = common.as_bytes(pa.array(["ab c", None, "", "d", " e"]))
    starts, ends, first = common.word_spans(data, at)
    assert [data[a:z].tobytes() for a, z in zip(starts, ends, strict=True)] == [b"ab", b"c", b"d", b"e"]
    assert first.tolist() == [0, 2, 2, 2, 3, 4]


def test_windows_of_short_rows():
    words = np.array([5, 6, 7, 8], np.uint64)
    full, at = common.windows(words, np.array([0, 3, 3, 4]), 2)
    assert at.tolist() == [0, 2, 2, 2]
    short, at = common.windows(words, np.array([0, 3, 3, 4]), 2, short=True)
    assert at.tolist() == [0, 2, 2, 3] and short[:2].tolist() == full.tolist()


def test_pieces_cover_all_rows_and_long_texts_stand_alone():
    data, at = common.as_bytes(pa.array(["a" * 3, "b" * 50, "", "c"]))
    found = [(row, end, bytes(d)) for row, end, d, _ in common.pieces(data, at, most=10)]
    assert found == [(0, 1, b"aaa"), (1, 2, b"b" * 50), (2, 4, b"c")]


# ---- quality rules -------------------------------------------------------------------------------------------


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    n = collections.Counter(triples)
    covered = {k + j for k, t in enumerate(triples) if n[t] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_counts(table):
    texts = [*corpus(1), "# a | b\n# a | b\n\n\nx", "x y z x y z\r\nx y z", "a\x0bb\x0cc d"]
    found = quality_rules.score(table(*texts), np.zeros(64)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found}
    assert got == {k: base_counts(t) for k, t in enumerate(texts)}


def test_ratio_is_that_of_counts_and_decides_alike(table, spark):
    texts = corpus(2)
    docs = table(*texts)
    trusted = spark.createDataFrame([(k,) for k in range(0, len(texts), 3)] + [(0,), (None,)], "doc_id long")
    counts = {r.bucket: (r.corpus, r.trusted) for r in quality_rules.gram_counts(docs, trusted, 16).collect()}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    grams = [2 * len(w) - 1 if w else 0 for w in words]
    assert sum(c for c, _ in counts.values()) == sum(grams)
    assert sum(t for _, t in counts.values()) == sum(g for k, g in enumerate(grams) if k % 3 == 0)
    ratio = quality_rules.fit(docs, trusted, 16)
    a = {r.doc_id: r.score for r in quality_rules.score(docs, ratio).collect()}
    b = {r.doc_id: r.score for r in quality_rules.score(docs.repartition(7), ratio).collect()}
    assert a == b and a[3] == 0.0


def test_kept_rows_are_as_they_were(table):
    docs = table(" ".join(f"w{k}" for k in range(60)), "few words", None, more=", score string, n_words string", value="own")
    kept = quality_rules.kept(docs, np.zeros(64))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [0]
    assert quality_rules.kept(docs.limit(0), np.zeros(64)).count() == 0


# ---- decontamination -------------------------------------------------------------------------------------------


def plain_matches(docs, items, window):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))

    windows = collections.defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[k : k + window])].add(item_id)
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    found |= windows[tuple(w[k : k + size])]
                    hit |= set(range(k, k + size))
        ids = sorted(str(i) for i in found if i is not None)
        out[doc_id] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_words", [200_000, 20])
def test_matches(table, spark, block_words):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["Aa", "bé", "c-", "d9", "中"]) for _ in range(rnd.randint(0, 40))) for _ in range(80)] + [None, "", "--"]
    items = [(k, " ".join(rnd.choice(["aa", "BÉ", "bé", "c", "D9", "zz"]) for _ in range(rnd.randint(0, 9)))) for k in range(25)] + [(3, "aa aa"), (None, "中 中"), (40, None)]
    found = decontaminate.report(decontaminate.matches(table(*texts), spark.createDataFrame(items, "item_id long, text string"), window=4, block_words=block_words))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()}
    assert got == plain_matches(list(enumerate(texts)), items, 4)


def test_clean_cuts_spans_and_drops_what_is_mostly_items(table, spark):
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    docs = table("Keep é this, One TWO-three four! and that too, or not", "one two three four", "clean", None, more=", spans string", value="own")
    out = decontaminate.clean(decontaminate.matches(docs.drop("spans"), items, window=4))
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {0: ("Keep é this, ! and that too, or not", 35), 2: ("clean", 5), 3: (None, None)}
    assert decontaminate.matches(docs, items.limit(0)).where("size(spans) > 0").count() == 0


# ---- encoding ------------------------------------------------------------------------------------------------------


ODD = ["a" * 3000, "the" * 900, " " * 700 + "x", "<|endoftext|>a<|endoftext|>", "x \x1c y\x85　z  ", "don't I'LL we've", "é" * 900, "👩‍💻 ½٣", "�́", "\n\n a\n \n"]


def test_ids_are_those_of_the_library_and_decode(table):
    texts = [*corpus(5), *ODD]
    library = Tokenizer.from_file(BYTE)
    found = bpe.digests(bpe.decode(bpe.encode(table(*texts), BYTE), BYTE), F.col("ids"), F.col("text")).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.text == library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_stream_needs_no_more_than_its_window(size):
    encoder, library = bpe.load(BYTE), Tokenizer.from_file(BYTE)
    rnd = random.Random(size)
    for text in ("".join(rnd.choice("theingabc") for _ in range(4000)), "ab" * 2000, "-=" * 1500):
        data = text.encode()
        assert list(encoder.stream(data[k : k + size] for k in range(0, len(data), size))) == library.encode(text, add_special_tokens=False).ids


def test_lookahead_follows_chains_of_merges():
    sizes = {i: 1 for i in range(4)} | {4: 2, 5: 3}
    assert bpe.lookahead([(0, 1, 4)], sizes) == 1
    assert bpe.lookahead([(1, 2, 4), (0, 1, 5)], sizes) == 2  # 1 may go with 2, and then not with 0
    assert bpe.lookahead([(0, 1, 5), (1, 2, 4)], sizes) == 1


def test_bytes_become_text_however_they_are_cut():
    data = "é中👩".encode() + b"\xff\xc3"
    assert bpe.text_of(data[k : k + 1] for k in range(len(data))) == data.decode("utf-8", "replace")


def test_unknown_ids_are_refused(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [99999])], "doc_id long, ids array<int>"), BYTE).collect()
    assert bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), BYTE).where("text = ''").count() == 2


def test_counts_for_every_limit(table):
    texts = corpus(6)
    lengths = np.array([len(Tokenizer.from_file(BYTE).encode(t or "", add_special_tokens=False).ids) for t in texts])
    limits = token_counts.by_limit(token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(table(*texts), BYTE)))).cache()
    rows = limits.collect()
    assert sorted(r.context_limit for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        longer = lengths[lengths > r.context_limit]
        assert (r.n_docs, r.n_longer, r.tokens_longer, r.total_tokens, r.truncated_tokens) == ((lengths == r.context_limit).sum(), len(longer), longer.sum(), lengths.sum(), np.minimum(lengths, r.context_limit).sum())
    assert token_counts.truncated_total(limits, 100) == np.minimum(lengths, 100).sum()
    for r in token_counts.quantiles(limits, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == np.sort(lengths)[math.ceil(r.share * len(lengths) - 1e-9) - 1]
    assert token_counts.histogram(token_counts.lengths(table().limit(0), BYTE)).count() == 0


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(table, spark, encoding):
    texts = [(k, t) for k, t in enumerate([*corpus(7), *ODD, "<|startoftext|> A"])] + [(None, "null id"), (2, "again"), (2, "again")]
    library = Tokenizer.from_file(WORD)
    files = token_files.write(table(*texts), WORD, 2, token_files.new_folder(spark), encoding).cache()
    got = {}
    for r in token_files.with_crc32(token_files.read(files)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    start, wanted = 0, {}
    for doc_id, text in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.setdefault(doc_id, []).append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {k: sorted(v) for k, v in got.items()} == wanted
    some = token_files.read(files, ("doc_id", "n_tokens"), 5, 9).collect()
    assert sorted(r.doc_id for r in some) == [5, 6, 7, 8, 9]
    assert token_files.write(table().limit(0), WORD, 2, token_files.new_folder(spark)).count() == 0


def test_token_files_look_up_distinct_pieces_only():
    """Ids are the library's for words with marks behind them, letters of a newer Unicode among them, and a frequent piece is looked up once a chunk."""
    texts = ["One, two; THREE!!! \u00c9t\u00e9... x\u0301### \u1c89### \u1c89 ***", "it's one. ONE ONE#$% <|endoftext|> a<|endoftext|>!! 3.5%% \u4e2d\u6587, \u1112\u1161.", "", None, " \n ", "A" * 300 + "??"] + ["word, " * 20_000]
    pieces, asked, looked_up = token_files.Pieces(WORD), [], []
    inner, ids_of = pieces._asked, pieces._ids
    pieces._asked = lambda stems: asked.extend(stems) or inner(stems)
    pieces._ids = lambda stems: looked_up.append(len(stems)) or ids_of(stems)
    library = Tokenizer.from_file(WORD)
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for kind in (pa.string(), pa.large_string()):
        ids, sizes = pieces.encode(pa.array(["left out", *texts], kind).slice(1))
        assert sizes.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]
    assert len(asked) == len(set(asked)) < 40 and max(looked_up) < 40
    assert {"one", "word", "#$%", ""} <= set(asked) and not {"One,", "ONE#$%", "word,"} & set(asked)


# ---- models --------------------------------------------------------------------------------------------------


def test_features_are_distinct_ngrams():
    data, at = common.as_bytes(pa.array(["ab ab", "", "ab ab", "c"]))
    found, first = classifier.features(data, at, 1 << 17)
    assert np.diff(first).tolist() == [1 + 1 + 3 + 1, 0, 6, 1 + 1]
    assert found[: first[1]].tolist() == found[first[2] : first[3]].tolist()


def test_features_are_told_apart_by_sorting(monkeypatch):
    """numpy's hash table of a million numbers takes many times as long as sorting them, so features never go by it."""
    plain, by_hash = np.unique, []

    def unique(ar, *args, **kwargs):
        if not (args or any(kwargs.values())):
            by_hash.append(len(ar))
        return plain(ar, *args, **kwargs)

    monkeypatch.setattr(np, "unique", unique)
    data, at = common.as_bytes(pa.array(["ab ab", "", "ab ab", "c"]))
    classifier.features(data, at, 1 << 17)
    assert not by_hash
    values = np.random.default_rng(5).integers(0, 50, 1000)
    assert common.distinct(values.copy()).tolist() == sorted(set(values.tolist())) and not len(common.distinct(np.zeros(0, np.int64)))


def test_classifier_tells_classes_apart_and_never_sees_the_rest(table, spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("gut fein klar".split() if k % 2 else "mies*** öde!! xx".split()) for _ in range(rnd.randint(1, 30))) for k in range(300)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)] + [(1, 0), (None, 1), (5, None)], "doc_id long, quality int")
    docs = table(*texts, None, "")
    model = classifier.fit(classifier.labelled(docs.where("doc_id % 3 <> 0"), labels, "quality"))
    scores = {r.doc_id: r.score for r in classifier.score(docs, model).collect()}
    assert all((scores[k] > 0.5) == bool(k % 2) for k in range(300)) and scores[300] == scores[301]
    assert all(0 <= s <= 1 for s in scores.values())
    one_class = classifier.fit(classifier.labelled(docs, labels.where("quality = 1"), "quality"))
    assert min(r.score for r in classifier.score(docs, one_class).collect()) > 0.99
    assert classifier.score(docs.limit(0), model).count() == 0


def test_descent_finds_the_margin():
    rows, values = [np.array([0]), np.array([1]), np.array([0, 1])], [np.array([1.0]), np.array([1.0]), np.array([1.0, -1.0])]
    weights, bias = classifier.descend(rows, values, np.array([1, -1, 1]), 2, cost=10.0, epochs=200)
    assert [np.sign(weights[r] @ v + bias) for r, v in zip(rows, values, strict=True)] == [1, -1, 1]


def test_scores(table):
    texts = corpus(9, n=80)
    docs = table(*texts)
    learns = ~(F.col("doc_id") % 5 == 2)
    found = {r.doc_id: r for r in mixing_lm.score(docs, learns).collect()}
    words = {k: [*re.findall(r"[^\x20\x09-\x0D]+", fold(t)), None] for k, t in enumerate(texts)}
    counts = collections.Counter(w for k, own in words.items() if k % 5 != 2 for w in own)
    total, kinds = sum(counts.values()), len(counts)
    for k, own in words.items():
        r = found[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own))
        assert r.score < 0 and (r.bits_per_byte is None or math.isnan(r.bits_per_byte)) == (not texts[k])
    assert mixing_lm.score(docs.limit(0), learns).count() == 0
    nothing = mixing_lm.score(docs, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)


def test_codes_are_a_distribution():
    """Over all codes of one place, probabilities add up to one."""
    rnd = np.random.default_rng(0)
    tables = mixing_lm.Tables(rnd.normal(size=(mixing_lm.CONTEXTS, mixing_lm.SLOTS)).astype(np.float32), np.zeros(mixing_lm.SLOTS, np.uint8), rnd.normal(size=(mixing_lm.BITS * mixing_lm.GATES, mixing_lm.CONTEXTS)), rnd.normal(size=(mixing_lm.BITS, 33)))
    n = 1 << mixing_lm.BITS
    tokens = np.arange(n, dtype=np.uint64) << np.uint64(64 - mixing_lm.BITS)
    contexts = np.repeat(rnd.integers(0, 1 << 63, (mixing_lm.CONTEXTS, 1), dtype=np.uint64), n, axis=1)
    assert (10 ** mixing_lm.log10_codes(mixing_lm.Stream(tokens, np.array([0, n]), contexts), tables)).sum() == pytest.approx(1.0)




def test_context_counts_are_those_of_the_whole_corpus():
    """Every context's counts are exact however many contexts there are: 3 million would share 2^20 slots."""
    rnd = np.random.default_rng(1)
    n = 3_000_000
    contexts = np.concatenate((np.arange(n, dtype=np.uint64), np.zeros(500, np.uint64)))
    tokens = rnd.integers(0, 1 << 63, n + 500, dtype=np.uint64)
    s = mixing_lm.Stream(tokens, np.array([0, n + 500]), np.stack([mixing_lm.mix(contexts)] * mixing_lm.CONTEXTS))
    found = mixing_lm.asked(mixing_lm.keys_of(s)[2:3], np.ones(n + 500))
    counts = mixing_lm.path_counts(found.keys, found.n)[found.place[0]]
    assert (counts[1:n] == 1).all()
    code = mixing_lm.codes(tokens[[0, *range(n, n + 500)]])
    for depth in (0, 1, 5, mixing_lm.BITS):
        node = code >> (mixing_lm.BITS - depth)
        assert counts[[0, *range(n, n + 500)], depth].tolist() == [(node == x).sum() for x in node]


def test_what_is_kept_of_contexts_stays_near_the_texts(table, spark, monkeypatch):
    """Answers to questions that blocks ask are small: a context that nobody else has costs next to nothing."""
    import pathlib

    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 9))) for _ in range(6000)]
    texts = [" ".join(words[int(len(words) ** rnd.random()) - 1] for _ in range(400)) for _ in range(300)]
    monkeypatch.setattr(mixing_lm, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(mixing_lm, "SHARD_BYTES", 400_000)
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "tributary"

    def kept():
        return sum(x.stat().st_size for x in folder.rglob("*.parquet"))

    before = kept()
    assert mixing_lm.score(table(*texts), F.col("doc_id") % 7 != 2).where("score < 0").count() == len(texts)
    share = (kept() - before) / sum(map(len, texts))
    assert 0 < share < 2.4, share


def test_counts_of_other_bundles_are_told_and_heard():
    rnd = np.random.default_rng(4)
    keys = np.unique((rnd.integers(0, 40, 3000).astype(np.uint64) << np.uint64(24)) | rnd.integers(0, 1 << 24, 3000).astype(np.uint64))
    n = rnd.integers(0, 5, len(keys))
    counts = mixing_lm.path_counts(keys, n, 24).T
    first = np.array([0, 700, 700, 2000, len(keys)])
    said = mixing_lm.told(keys, first, 24, counts)
    assert len(said) == 4
    heard = np.stack(list(mixing_lm.heard(keys, first, 24, said)))
    assert (heard == counts).all()
    assert sum(map(len, mixing_lm.told(keys, first, 24, np.zeros_like(counts)))) < 200


def test_odds_are_worked_out_only_where_something_is_lost(monkeypatch):
    """Counts are those of the whole corpus, and a context that always went on alike, or that nobody else has, takes no logarithms."""
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(words[int(len(words) ** rnd.random()) - 1] for _ in range(300)) for _ in range(40)] + ["", "ab"]
    n_shards, levels, learns = 3, 3, [k % 5 != 2 for k in range(len(texts))]
    held, said = {}, collections.defaultdict(list)

    def rows(tables):
        return [tuple(r.values()) for t in tables for r in t.to_pylist()]

    def answer(asked, work):
        by_shard = collections.defaultdict(list)
        for r in asked:
            by_shard[r[2]].append(r)
        for own in by_shard.values():
            for r in rows(work(iter(mixing_lm._rows(own).to_batches()))):
                said[r[0]].append(r)

    def table(number):
        return mixing_lm._rows([held[number], *said[number]])

    for number in (0, 1):
        own = [k for k in range(len(texts)) if k % 2 == number]
        columns = {"doc_id": pa.array(own, pa.int64()), "text": pa.array([texts[k] for k in own]), "block": pa.array([number] * len(own), pa.int32()), "learns": pa.array([learns[k] for k in own])}
        held[number] = mixing_lm._bundled(number, pa.table(columns))
    answer(rows(mixing_lm._name(n_shards)(table(number)) for number in held), mixing_lm._named)
    for unit in range(len(mixing_lm.UNITS)):
        answer(rows(mixing_lm._ask(unit, levels, n_shards)(table(number)) for number in held), mixing_lm._count)

    taken, plain = [], mixing_lm.path_logits
    monkeypatch.setattr(mixing_lm, "path_logits", lambda keys, counts: taken.append(len(keys)) or plain(keys, counts))
    learnt = [mixing_lm._learn(n_shards, levels)(table(number)) for number in held]
    assert sum(sum(t.column("tokens").to_pylist()) for t in learnt) > 0
    distinct = sum(len({(k, *x) for x in zip(own, own[1:], own[2:])}) for k, own in enumerate([["", "", *t.split(), ""] for t in texts]))
    assert sum(taken) < 6 * distinct, (sum(taken), distinct)  # of four kinds of contexts at three levels, and spelling

    pairs = collections.Counter(x for k, t in enumerate(texts) if learns[k] for x in zip(["", *t.split()], [*t.split(), None]))
    for number in held:
        k = mixing_lm._known(table(number), n_shards)
        found = np.full(len(k.count), -1)
        for unit, kinds in enumerate(mixing_lm.UNITS):
            questions = mixing_lm._asked(k, unit, levels, n_shards)
            answers = mixing_lm._answered(table(number), unit, questions)
            for j, (kind, _) in enumerate(kinds):
                if kind == 1:
                    for q, counts in list(zip(questions, answers, strict=True))[j * (levels + 1) :: levels][:2]:
                        if len(q.own):
                            found[q.own] = counts[-1][q.place]
        expected = [x for t in texts[number::2] for x in zip(["", *t.split()], [*t.split(), None])]
        known = k.count > 0
        assert found[known].tolist() == [pairs[x] for x, yes in zip(expected, known, strict=True) if yes]
        assert known.tolist() == [any(b == x[1] for _, b in pairs) for x in expected]


def test_unseen_words_cost_what_their_bytes_do(table):
    """A long run without blanks is not the most fluent text of all, and letters that words have are cheaper than others."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(900)]
    seen = [" ".join(rnd.choice(words) for _ in range(80)) for _ in range(60)]
    run = "".join(rnd.choice("abcdefgh") for _ in range(3000))
    odd = "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(1000))
    found = {r.doc_id: r.bits_per_byte for r in mixing_lm.score(table(*seen, run, odd), F.col("doc_id") < 60).collect()}
    assert 2.5 < found[60] < 4.5 and found[61] > 6
    assert max(found[k] for k in range(60)) < found[60]


def test_modelled_bits_follow_the_vocabulary():
    assert [mixing_lm.levels_of(n) for n in (0, 200, 300, 60_000, 70_000, 1 << 24)] == [1, 1, 2, 2, 3, 4]


def test_learnt_mixture_beats_each_context_on_text_not_learnt():
    rnd = random.Random(11)
    words = [f"w{k}" for k in range(200)]
    after = {w: rnd.sample(words, 3) for w in words}

    def text():
        own = [rnd.choice(words)]
        for _ in range(60):
            own.append(rnd.choice(after[own[-1]]) if rnd.random() < 0.8 else rnd.choice(words))
        return " ".join(own)

    s = mixing_lm.stream(*common.as_bytes(pa.array([text() for _ in range(600)])))
    code, keys = mixing_lm.codes(s.tokens), mixing_lm.keys_of(s)
    learns = np.arange(len(code)) < s.first[500]
    found = mixing_lm.asked(keys, learns)
    counts = mixing_lm.path_counts(found.keys, found.n)

    def given(counts):
        logits, seen = mixing_lm.path_logits(found.keys, counts)
        return logits[found.place], mixing_lm._gate(seen)[found.place[mixing_lm.GATED]]

    logits, gate = given(np.maximum(counts - 1, 0))
    learner = mixing_lm.Learner()
    for k in range(0, s.first[500], mixing_lm.LEARN):
        some = slice(k, min(k + mixing_lm.LEARN, s.first[500]))
        learner.read(code[some], logits[:, some], gate[some])
    logits, gate = given(counts)
    plain = np.zeros((mixing_lm.BITS, 33))

    def total(weights):
        return mixing_lm.log10_bits(code[~learns], logits[:, ~learns], gate[~learns], weights, plain).sum()

    singles = [total(np.eye(mixing_lm.CONTEXTS)[[k] * (mixing_lm.BITS * mixing_lm.GATES)]) for k in range(mixing_lm.CONTEXTS)]
    start = total(np.full(learner.weights.shape, 0.4))
    assert total(learner.weights) > max(*singles, start)


def test_columns_named_like_the_operators_come_back_as_they_were(table, spark):
    more = ", n_words string, spans string, items string, ranges string, n_bytes string, removed string, kept string, doc_key string, row string"
    passage = " ".join(f"p{k}" for k in range(90))
    docs = table("one two three four five six seven eight nine ten and more " + "other words " * 6, "a begin " + passage, "b front " + passage, None, more=more, value="own")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    for out, texts in ((suffix_dedup.clean(docs), {1: "a begin", 2: "b front"}), (decontaminate.without_items(docs, items), {0: "and more"})):
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = {r.doc_id: r for r in out.collect()}
        assert len(rows) == 4 and all(r[n] == "own" for r in rows.values() for n in docs.columns[5:])
        for k, text in texts.items():
            assert rows[k].text.strip().startswith(text) and passage not in rows[k].text and rows[k].n_chars == len(rows[k].text)
