"""Vector codes, token alignment and shards against plain versions."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import corpus
from tributary.llm import alignment, sharding, vector_codes


def plain_shards(docs: list[tuple], n: int) -> dict:
    """``doc_id, text`` to ``size, crc32, shard, slot`` by trying capacities one by one."""
    groups: dict[str, list] = {}
    for doc_id, text in docs:
        groups.setdefault(text or "", []).append(doc_id)
    size = {t: len(ids) * (len(t.encode()) + 8) for t, ids in groups.items()}
    digest = {t: hashlib.sha256(t.encode()).digest() for t in groups}
    own, left = [], sum(size.values())
    for t in sorted(groups, key=lambda t: (-size[t], digest[t])):
        if len(own) == n - 1 or size[t] <= left / (n - len(own)):
            break
        own.append(t)
        left -= size[t]
    order = sorted(set(groups) - set(own), key=digest.get)

    def greedy(capacity):
        out, held = [[]], 0
        for t in order:
            if held + size[t] > capacity:
                out.append([])
                held = 0
            out[-1].append(t)
            held += size[t]
        return out

    shards = [[]]
    if order:
        capacity = max(max(size[t] for t in order), -(-left // (n - len(own))))
        while len(greedy(capacity)) > n - len(own):
            capacity += 1
        shards = greedy(capacity)
    out = []
    for k, texts in enumerate([[t] for t in own] + shards):
        slot = 0
        for t in texts:
            for doc_id in sorted(groups[t], key=lambda i: (i is not None, i or 0)):
                out.append((doc_id, len(t.encode()) + 8, zlib.crc32(t.encode()), k, slot))
                slot += 1
    return out


@pytest.mark.parametrize(("seed", "n", "hot", "finer"), [(1, 24, 0, 1 << 16), (2, 5, 0, 4), (3, 24, 120, 2), (4, 7, 30, 3), (5, 1, 4, 8), (6, 150, 9, 64)])
def test_shards(spark, table, seed, n, hot, finer):
    rnd = random.Random(seed)
    texts = corpus(seed, n=90) + ["hot " * 60] * hot
    docs = [(rnd.choice([k, k, k, 7, None]), t) for k, t in enumerate(texts)]
    found = sharding.assign(table(*docs), n, block_rows=16, finer=finer).collect()
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    key = lambda r: (r[3], r[4], r[1])
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found), key=key) == sorted(plain_shards(docs, n), key=key)


def test_shards_of_odd_tables(spark, table):
    assert sharding.assign(table()).count() == 0
    few = sharding.assign(table(None, "", None, "a", more=", size long, shard string, key string")).collect()
    assert sorted((r.doc_id, r.size, r.slot) for r in few)[0][1] == 8 and len({r.shard for r in few if r.doc_id != 3}) == 1
    long = sharding.assign(table("x" * 3_000_000, *["y" * k for k in range(60)])).collect()
    assert [r.slot for r in long if r.doc_id == 0] == [0] and max(r.shard for r in long) == 23


# ---- vector codes -------------------------------------------------------------------------------------------------


def plain_codes(rows: list[tuple], parts: int, entries: int, rounds: int) -> tuple[dict, dict, str]:
    whole = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(whole[0][1]) // parts
    cut = [[tuple(math.floor(256 * x) for x in v[a : a + size]) for a in range(0, parts * size, size)] for _, v, _ in whole]
    first = sorted(range(len(whole)), key=lambda k: (whole[k][0] is None, whole[k][0] or 0, whole[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            mine: dict[int, list] = {}
            for x in cut:
                mine.setdefault(nearest(p, x[p])[1], []).append(x[p])
            books[p] = [tuple(sum(v) // len(mine[e]) for v in zip(*mine[e], strict=True)) if e in mine else c for e, c in enumerate(books[p])]
    found, by_label = [], {}
    for (i, _, label), x in zip(whole, cut, strict=True):
        best = [nearest(p, x[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] = by_label.get(label, 0) + error
        found.append((i, "".join(f"{e:02x}" for _, e in best), error, label))
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    return found, by_label, digest


@pytest.mark.parametrize(("seed", "n", "length", "scale"), [(1, 300, 16, 1.0), (2, 90, 48, 0.3), (3, 40, 32, 90000.0), (4, 700, 16, 0.01)])
def test_vector_codes(spark, monkeypatch, seed, n, length, scale):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", seed)
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, scale) for _ in range(length)] for _ in range(9)]
    rows = [(rnd.choice([k, k, k, 5, None]), [x + rnd.gauss(0, scale / 9) for x in rnd.choice(middles)], rnd.choice([1, 1, 1, None, 2, 3])) for k in range(n)]
    rows += rows[:20] + [(3, None, 1), (4, [0.5] * (length - 1) + [None], 1), (5, [float("nan")] * length, 2), (6, [1.0] * (length - 1) + [float("-inf")], None)]
    rnd.shuffle(rows)
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id int, embedding array<double>, label int, code string").repartition(3)
    codes = vector_codes.Codes(table)
    wanted, by_label, digest = plain_codes(rows, 16, 64, 2)
    found = vector_codes.report(codes).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found), key=key) == sorted(((i, c, e, by_label[label], digest) for i, c, e, label in wanted), key=key)
    one = codes.decoded(codes.encoded().where("vec_id = 5")).collect()[0]
    assert len(one.vector) == length and all(float(256 * x).is_integer() for x in one.vector)


def test_vector_codes_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label string"
    assert vector_codes.report(vector_codes.Codes(spark.createDataFrame([], kind))).count() == 0
    assert vector_codes.report(vector_codes.Codes(spark.createDataFrame([(1, None, "a"), (2, [None] * 16, None)], kind))).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.Codes(spark.createDataFrame([(1, [1.0] * 15, "a")], kind))
    with pytest.raises(ValueError, match="too large"):
        vector_codes.Codes(spark.createDataFrame([(1, [1e30] * 16, "a")], kind))


@pytest.mark.parametrize(("axes", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_goes_step_by_step(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)), np.int64)
    places = vector_codes.curve_places(cells)
    assert sorted(places.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


def test_shortlists_lose_nothing():
    rnd = np.random.default_rng(3)
    points = np.concatenate([rnd.normal(m, 9, (500, 4)) for m in rnd.integers(-400, 400, (20, 4))]).astype(np.int64)
    entries = points[:: len(points) // 63]
    part, sizes = vector_codes.Part(points), []
    for blocks, entry, _ in part.assigned(entries, sizes):
        wanted = ((part.blocks[blocks][:, :, None] - entries) ** 2).sum(axis=3).argmin(axis=2)
        assert (wanted == entry.reshape(len(blocks), -1)).all()
    assert np.mean(sizes) < 16


# ---- alignment ------------------------------------------------------------------------------------------------------

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(docs: list[tuple]) -> list[tuple]:
    a_model, b_model = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_model.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    held, counts = [], {}
    for doc_id, text in docs:
        wanted = (" " + (text or "")).encode()
        a = [(k, bytes(letters[c] for c in a_model.id_to_token(k))) for k in a_model.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = []
        for k in b_model.encode(text) if text else []:
            piece = b_model.id_to_piece(k)
            b.append((k, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("\u2581", " ").encode()))
        if not text or any(b"".join(x for _, x in side) != wanted for side in (a, b)):
            held.append((doc_id, [], [], [], []))
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for k, x in side:
                out.append((k, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = []
        for k, s, e in spans[0]:
            links += [(k, n) for n, v, w in spans[1] if v < e and s < w]
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = []
        for s, e in zip([0, *ends], ends):
            groups.append("|".join(",".join(str(k) for k, _, w in side if s < w <= e) for side in spans))
        held.append((doc_id, a, b, groups, links))
        for p in set(links):
            counts[p] = counts.get(p, 0) + 1
    best: dict = {}
    for (k, _), n in counts.items():
        best[k] = max(best.get(k, 0), n)
    digest = lambda groups: hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
    return [(i, len(a), len(b), len(g), len(x), sum(counts[p] == best[p[0]] for p in x), sum(counts[p] for p in x), digest(g)) for i, a, b, g, x in held]


ODD = ["<|endoftext|> a <s> b </s>", "<0x41>", "x\u2581y", " lead", "tail \n", "  two  blanks   ", "\r\n\t\x0b", "日本語の文章。" * 9, "e\u0301 \u00e9 \u200b\ufeff", "\x00\x01", "a\u00a0b", "😀😀 👩‍👩‍👧"]


@pytest.mark.parametrize(("seed", "long", "width", "head"), [(1, 1 << 16, 1 << 13, 1 << 18), (2, 40, 7, 50), (3, 5, 1, 1), (4, 100, 30, 0)])
def test_alignment(spark, table, seed, long, width, head):
    texts = corpus(seed, n=25, words=60) + ODD + [f"{ODD[7]} {' '.join(ODD)} {seed}", ODD[7] * 30]
    docs = [(k if k % 5 else 5, t) for k, t in enumerate(texts)] + [(None, "an id of null"), (None, None)]
    aligned = alignment.align(table(*docs, more=", pairs string, key string"), *PATHS, long=long, width=width)
    counts = alignment.pair_counts(aligned, alignment.load(*PATHS).most_b)
    found = [tuple(r) for r in alignment.with_counts(aligned, counts, head=head).collect()]
    key = lambda r: (r[0] is None, *r[1:], r[0] or 0)
    assert sorted(found, key=key) == sorted(plain_alignment(docs), key=key)


def test_alignment_of_odd_tables(spark, table):
    assert alignment.report(table(), *PATHS).count() == 0
    assert sorted(tuple(r) for r in alignment.report(table(None, ""), *PATHS).collect()) == [(k, 0, 0, 0, 0, 0, 0, "") for k in range(2)]
    long = "".join(random.Random(5).choice(["word ", "日本", "x1 ", "\n\n", "  ", "é"]) for _ in range(400_000))
    whole, chunked = (alignment.align(table(long, long + "\u2581"), *PATHS, long=size).drop("key").orderBy("doc_id").collect() for size in (1 << 30, 1 << 16))
    assert whole == chunked and whole[0].n_groups > 1000 and whole[1].n_groups == 0


def test_fragments_compose_in_any_tree():
    both = alignment.load(*PATHS)
    (a, b), rnd = both.tokens([" ".join(ODD[:2] + ODD[3:] + [t for t in corpus(7, n=9) if t])])[0], random.Random(8)
    sizes_a, sizes_b = both.spelt_a.sizes[a], both.spelt_b.sizes[b]
    whole = alignment.fragments(a, sizes_a, b, sizes_b, 1 << 40, both.most_b)[0]
    whole = alignment.start().then(whole, both.most_b)
    for width in (1, 2, 5, 17, 64):
        some = [alignment.start(), *alignment.fragments(a, sizes_a, b, sizes_b, width, both.most_b)]
        assert any(not f.cut for f in some) or width > 2
        while len(some) > 1:
            k = rnd.randrange(len(some) - 1)
            some[k : k + 2] = [some[k].then(some[k + 1], both.most_b)]
        one = some[0].groups
        assert one.text == whole.groups.text and one.n_links == whole.groups.n_links and (one.pairs == whole.groups.pairs).all() and (one.links == whole.groups.links).all()
        assert not len(some[0].before.ids_a) and not len(some[0].after.ids_b)
