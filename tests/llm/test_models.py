import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, awkward
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import features, language, mixing, quality, token_files, topk, toxicity
from tidemark.llm.common import crc32_mod

ENCODER = public_tokenizers.path("word_bpe_49k.json")


def rows(df):
    return [tuple(r) for r in df.collect()]


def texts_of(words, n, seed, size=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(size)) for _ in range(n)]


PLAIN = "the of tide over stone harbour evening quiet boats return with light wind and slow water".split()


def labelled(spark, good, bad):
    data = [(i, t, 1) for i, t in enumerate(good)] + [(1000 + i, t, 0) for i, t in enumerate(bad)]
    return spark.createDataFrame(data, "doc_id bigint, text string, label int")


@pytest.mark.parametrize("kind", ["quality", "toxicity"])
def test_classifiers_learn_and_score_every_row(spark, kind):
    good, bad = texts_of(PLAIN, 150, 1), [t.upper().replace(" ", "!! ") + " you gronk" for t in texts_of(PLAIN, 150, 2)]
    module = {"quality": quality, "toxicity": toxicity}[kind]
    rows_ = labelled(spark, good, bad)
    model = module.fit(rows_, rows_, "label")
    test = spark.createDataFrame(list(enumerate(texts_of(PLAIN, 20, 3) + [t.upper().replace(" ", "!! ") + " you gronk" for t in texts_of(PLAIN, 20, 4)])), "doc_id bigint, text string")
    got = dict(rows(module.score(test, model)))
    assert all((got[i] >= 0.5) == (i < 20) for i in range(40)), got
    odd = rows(module.score(awkward(spark), model))
    assert Counter(r[0] for r in odd) == Counter(r[0] for r in AWKWARD) and all(0 <= r[1] <= 1 for r in odd)
    assert module.score(awkward(spark, []), model).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_without_both_classes(spark, module):
    some = labelled(spark, texts_of(PLAIN, 5, 1), [])
    one = module.fit(some, some, "label")
    assert {r[1] for r in rows(module.score(awkward(spark), one))} == {1.0}
    none = module.fit(some, labelled(spark, [], []), "label")
    assert module.score(awkward(spark), none).count() == len(AWKWARD)


def test_obfuscated_words_are_undone():
    assert toxicity.plain_word("L0s3r!!") == ("loser", True)
    assert toxicity.plain_word("s.t.u.p.i.d")[0] == "stupid"
    assert toxicity.plain_word("well-known")[0] == "wellknown" and not toxicity.plain_word("well-known")[1]
    assert "idiot" in toxicity.tokens("such an i d i o t here")


def test_calibrations_are_monotone():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-2 * x))).astype(float)
    at, value = features.isotonic(x, y)
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= -1e-12).all()
    a, b = features.sigmoid(x, y)
    assert 1.2 < a < 3 and abs(b) < 0.6


def test_languages(spark):
    kinds = {"aa": "ka ta ma pa ra".split(), "bb": "sch ung ein ver lich".split(), "cc": "eau tion ment oi ais".split()}
    rng = random.Random(5)
    text = lambda parts: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(30))
    data = [(i, text(kinds[k]), k) for i, k in enumerate(sorted(kinds) * 40)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    held = crc32_mod(F.col("doc_id"), 5) == 0
    model = language.fit(df.where(~held))
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in data) >= 0.98 * len(data)
    odd = language.predict(awkward(spark), model).collect()
    assert len(odd) == len(AWKWARD)
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {3, 4, 5} and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in language.predict(awkward(spark), language.fit(df.where("false"))).collect()} == {"und"}


def plain_top(data, k, every):
    sound = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sound:
        if q % every:
            continue
        found = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q))[:k]  # noqa: B905
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_top_k_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=20).round(1)]) for i in range(400)]
    data += [(400 + i, data[i][1]) for i in range(60)]  # ties
    data += [(None, data[0][1]), (900, None), (901, [1.0, None]), (902, [float("nan")] * 20), (903, [float("inf")] * 20), (1000, [0.5, 0.25])]
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id bigint, embedding array<float>, v string")
    for most, few in ((8 * 20 * 9, 2048), (8 * 20 * 64, 2048), (1 << 24, 50), (1 << 24, 2048)):
        monkeypatch.setattr(topk, "MATRIX_BYTES", most)
        monkeypatch.setattr(topk, "FEW", few)
        assert sorted(rows(topk.top_k(df, F.col("vec_id") % 20 == 0, k=7))) == plain_top(data, 7, 20)
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0
    assert len(rows(topk.top_k(df.where("vec_id < 3"), F.lit(True), k=10))) == 6


def test_best_of_block_of_numbers_beyond_doubles():
    rng = np.random.default_rng(8)
    q, c = rng.integers(-(1 << 28), 1 << 28, (40, 50)), rng.integers(-(1 << 28), 1 << 28, (40, 300))
    whole = q.T @ c
    floors = np.where(np.arange(50) % 2, np.sort(whole, 1)[:, -5].astype(float), np.nan)
    for i, (at, scores) in enumerate(topk.best_of_block(q, c, np.full(50, -1), np.arange(300), 5, floors)):
        want = np.lexsort((np.arange(300), -whole[i]))[:5]
        assert at.tolist() == want.tolist() and scores.tolist() == whole[i][want].tolist()


ODD = ["a\x1fb c", "x\x85y z w", "　lead <|endoftext|> and<|startoftext|>tail", "don't I'll 12 3,4 -- é É é ́x", "tab\tand\x0bvt\x0cff", "ﬁ ǅ 你好 \U0001f600​"]


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_round_trip(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(token_files, "CHUNK", 1 << 16)
    data = [(i, t) for i, t, _ in AWKWARD] + [(50 + i, t) for i, t in enumerate(ODD)] + [(90, " ".join(f"w{i}" for i in range(40_000)))]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in data], "doc_id bigint, text string, first int, block int")
    token_files.write(df, f"{tmp_path}/f", ENCODER, 1, bits=bits, shards=3)
    got = rows(token_files.read_documents(spark, f"{tmp_path}/f"))
    tokenizer = Tokenizer.from_file(ENCODER)
    want, at = [], 0
    for i, t in data:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert Counter((i, n, c) for i, _, n, c in got) == Counter(want)
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order[0] is None and order[1:] == sorted(order[1:])
    token_files.write(df.where("false"), f"{tmp_path}/none", ENCODER, 1)
    assert token_files.read_documents(spark, f"{tmp_path}/none").count() == 0


def test_words_in_pieces_have_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "PIECES", 40)
    made, plain = token_files.PieceEncoder(ENCODER, "</w>"), Tokenizer.from_file(ENCODER)
    rng = random.Random(8)
    alphabet = list("abcXYZéÉßÿÖ,.!?<|>'`~[]{}#0 \t\n") + ["the ", "'s", "don't ", "é", "<|endoftext|>", "İ", "ﬁ", "ª", "×", "\x1c", "\xa0", "中", "٣"]
    for _ in range(60):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(20)]
        ids, counts = made.encode(texts)
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_a_tokenizer_of_another_kind_gets_whole_texts(spark, tmp_path):
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert type(token_files._encoder(ENCODER)) is token_files.PieceEncoder and type(token_files._encoder(other)) is token_files.WholeEncoder
    data = [(i, t) for i, t, _ in AWKWARD] + [(50 + i, t) for i, t in enumerate(ODD)]
    token_files.write(spark.createDataFrame(data, "doc_id bigint, text string"), f"{tmp_path}/f", other, 50256, shards=2)
    plain = Tokenizer.from_file(other)
    want = Counter((i, zlib.crc32(np.array([*plain.encode(t or "", add_special_tokens=False).ids, 50256], "<u4").tobytes())) for i, t in data)
    assert Counter((r.doc_id, r.ids_crc32) for r in token_files.read_documents(spark, f"{tmp_path}/f").collect()) == want


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(width, bits):
    ids = np.random.default_rng(1).integers(0, 1 << (8 * width), 1001).astype(np.uint32)
    planes = token_files.to_planes(ids, width, bits)
    assert len(planes) == width * (8 if bits else 1)
    assert (token_files.from_planes(planes, len(ids), width) == ids).all()


def test_bisection_meets_its_targets():
    tokens = {"a": 1000, "b": 100, "c": 10, "d": 0}
    high = mixing.plan(tokens, target_entropy=1.0)
    assert abs(mixing.entropy(high.weights) - 1.0) < 1e-6 and high.weights["d"] == 0
    assert mixing.plan(tokens, target_entropy=0.1).alpha == 1.0
    limited = mixing.plan(tokens, max_repeat=4.0)
    assert abs(mixing.repetition(tokens, limited.weights, None) - 4.0) < 1e-6
    assert min(limited.budgets[s] - n for s, n in tokens.items()) >= -1


def test_mixing_takes_equal_rows_one_by_one(spark):
    data = [(1, "w " * 10, "a")] * 400 + [(i, "w " * 10, "b") for i in range(2, 202)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    mixed, plan = mixing.mix(df, target_entropy=0.69, budget=5000)
    spent = Counter()
    for r in mixed.collect():
        spent[r.source] += r["__tokens"] * r["__copies"]
    assert all(0 <= spent[s] - plan.budgets[s, False] < 10 for s in "ab"), (spent, plan.budgets)


def test_mixing_spends_each_budget(spark):
    rng = random.Random(7)
    data = [(i, " ".join(["w"] * rng.randrange(1, 30)), rng.choice("aaaaaaaab") if i % 9 else None) for i in range(3000)]
    data += [(5000, None, "a"), (5001, "", "z"), (None, "w w", "b"), (7, data[7][1], data[7][2])]
    df = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id bigint, text string, source string, tokens int, block int")
    mixed, plan = mixing.mix(df, max_repeat=3.0, seed=3)
    got = mixed.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(data)
    spent, longest = Counter(), 30
    for r in got:
        assert r.__getitem__("__tokens") == len((r.text or "").split())
        spent[(r.source or "", r.source is None)] += r["__tokens"] * r["__copies"]
        assert r["__copies"] >= 1
    for s, budget in plan.budgets.items():
        assert 0 <= spent[s] - budget <= longest, (s, spent[s], budget)
    again = Counter((r.doc_id, r["__copies"]) for r in mixing.mix(df.repartition(7), max_repeat=3.0, seed=3)[0].collect())
    assert again == Counter((r.doc_id, r["__copies"]) for r in got)
    many = mixing.repeated(mixed)
    assert many.columns == df.columns and many.count() == sum(r["__copies"] for r in got)
    assert mixing.mix(df.where("false"))[0].count() == 0


def test_language_landmarks_stay_bounded_however_many_labels():
    for kinds, per in ((1, 300), (4, 200), (100, 3), (129, 2), (1000, 1)):
        codes = np.repeat(np.arange(kinds), per)
        marks = language.landmarks(codes, kinds)
        assert len(set(marks.tolist())) == len(marks) <= language.LANDMARKS
        assert len(set(codes[marks].tolist())) >= min(kinds, language.LANDMARKS)


def test_language_learns_every_one_of_many_labels(spark, monkeypatch):
    monkeypatch.setattr(language, "ROWS", 600)
    rows = [(i, " ".join(chr(97 + i % 26) * 3 + chr(97 + i // 26 % 8) * 2 for _ in range(6)), f"l{i % 200}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(language.fit(df).names) == 200
    monkeypatch.setattr(language, "ROWS", 150)
    with pytest.raises(ValueError):
        language.fit(df)
