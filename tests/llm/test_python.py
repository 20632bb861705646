"""Personal data, pieces, chat, toxicity and language: fixed patterns, round trips, held-out rows."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import helpers as H
from variantloom.llm import chat_format, language_id, piece_sampling, pii, toxicity

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def base_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    for n in range(8000):
        letters = "0123456789 -.+" if n % 3 == 0 else "a1.@+ -_()2é9%"
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 70)))
        assert [s[:3] for s in pii.find_spans(text) if s[3]] == base_spans(text), text


def test_base_spans_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 200_000, "1." * 200_000, "+1" + " " * 400_000, "1 " * 200_000):
        pii.find_spans(text)


def test_secrets_are_covered_to_their_end():
    for size in (15, 16, 256, 257, 3000, 400_000):
        spans = [s[:3] for s in pii.find_spans("token = " + "aB-_" * (size // 4) + "c" * (size % 4) + " end") if s[0] == 4]
        assert spans == ([(4, 8, 8 + size)] if size >= 16 else [])


def test_codes_and_em():
    for kind, vote in itertools.product(range(5), itertools.product(range(3), repeat=5)):
        assert pii.decode(pii.code_of(kind, vote, 9)) == (kind, list(vote), 9)
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    right = (0.9, 0.7, 0.6, 0.8, 0.65)
    votes = [tuple(int(pii.FOR if (rng.random() < r) == t else pii.AGAINST) if rng.random() < 0.8 else pii.NONE for r in right) for t in truth]
    codes, at, counts = np.unique([pii.code_of(2, v, 0) for v in votes], return_inverse=True, return_counts=True)
    post = pii.estimate_labels(codes, counts)
    assert ((post[at] > 0.5) == truth).mean() > 0.85
    weights = pii.train_classifier(codes, counts, post)
    assert (((pii.probability(codes, weights)[at] > 0.5) == truth).mean()) > 0.85


def test_pii_rows(spark):
    card = next(str(n) for n in range(4000000000000000, 4000000000000200) if pii.luhn(str(n)))
    rows = [(1, None), (2, ""), (3, f"é mail bo.b@x.org card {card}, ip 10.0.0.1 call +1 (222) 555-1234"), (3, "plain"), (None, "999.1.1.1 token = \"" + "0a1b" * 10 + '"'), (5, "x " * 300_000 + "a@b.co")]
    got = {(r.id, r.spans): r for r in pii.span_texts(pii.detect(H.documents(spark, rows))).collect()}
    assert len(got) == 6
    three = next(r for r in got.values() if r.id == 3 and r.spans)
    assert (three.n_email, three.n_ip, three.n_card, three.n_phone) == (1, 1, 1, 1) and three.base.startswith("email:7:17,ip:")
    last = next(r for r in got.values() if r.id is None)
    assert last.base == "" and last.spans == "secret:19:59"
    assert next(r for r in got.values() if r.id == 5).base == "email:600000:600006"
    assert pii.span_texts(pii.detect(H.documents(spark, []))).count() == 0


def _segmentations(text, vocabulary):
    """Every segmentation with its weight, by trying all cuts."""
    weight = {}
    for length, (_, ids, letters) in vocabulary.tables.items():
        weight |= {"".join(map(chr, row)): (int(i), float(np.exp(vocabulary.log_weight[i]))) for i, row in zip(ids, letters, strict=True) if length <= len(text)}
    written = text.replace(" ", piece_sampling.BLANK)

    def cuts(at):
        if at == len(text):
            yield (), 1.0
        for end in range(at + 1, len(text) + 1):
            if written[at:end] in weight:
                piece, w = weight[written[at:end]]
                for rest, x in cuts(end):
                    yield (piece, *rest), w * x

    return dict(cuts(0))


def test_sampled_segmentations_have_their_shares():
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.model_file(), 0.3)
    sampler = piece_sampling.Sampler(vocabulary)
    every = _segmentations(" then", vocabulary)
    total, n = sum(every.values()), 30_000
    drawn = [tuple(x.tolist()) for x in sampler.encode(list(range(n)), [" then"] * n)]
    assert set(drawn) <= set(every)
    for pieces, w in every.items():
        p = w / total
        assert abs(drawn.count(pieces) / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4, (pieces, p)


def test_pieces_decode_and_depend_on_key_and_text_only():
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.model_file())
    rng = random.Random(5)
    texts = ["", " ", "  a  b", "▁ ▁x▁", "日本\n語\t🎉", "x" * 300, " " * 100, "\x00\x01", "word " * 50_000]
    texts += ["".join(rng.choice("ab é▁\n🎉") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    one = piece_sampling.Sampler(vocabulary).encode(list(range(len(texts))), texts)
    assert [piece_sampling.decode(i.tolist(), vocabulary) for i in one] == texts
    sampler = piece_sampling.Sampler(vocabulary)
    for k in reversed(range(len(texts))):
        assert sampler.encode([k], [texts[k]])[0].tolist() == one[k].tolist()


def _arc_shares(text, weight, longest):
    """How often each piece stands at each place, by sums over the whole text from both ends."""
    n = len(text)
    arcs = [(i, j, *weight[text[i:j]]) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1) if text[i:j] in weight]
    ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for i, j, _, w in arcs:
        ahead[j] += ahead[i] * w
    for i, j, _, w in reversed(arcs):
        behind[i] += behind[j] * w
    return {(i, piece): ahead[i] * w * behind[j] / ahead[n] for i, j, piece, w in arcs}


def test_shares_of_long_runs_and_of_blanks():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_sampling.model_file())
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.model_file(), 0.3)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    usual = [i for i in range(len(names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    weight = {names[i]: (i, (i + 1.0) ** -0.3) for i in usual}
    assert sum(set(names[i]) == {piece_sampling.BLANK} and len(names[i]) > 1 for i in usual) > 10
    n = 4000
    for text in ("therefore" * 12, "x" + " " * 20 + "if then", "  a" + " " * 70 + "the", "https://the.example.org/" + "information/" * 6):
        want = _arc_shares(text.replace(" ", piece_sampling.BLANK), weight, vocabulary.longest)
        counts = dict.fromkeys(want, 0)
        for ids in piece_sampling.Sampler(vocabulary).encode(list(range(n)), [text] * n):
            at = 0
            for i in ids.tolist():
                counts[at, i] += 1
                at += len(names[i])
            assert at == len(text)
        for arc, p in want.items():
            assert abs(counts[arc] / n - p) < 5.5 * (p * max(1 - p, 0) / n) ** 0.5 + 2e-3, (text, arc, p)


def test_long_runs_are_cut_only_where_no_piece_crosses():
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.model_file())
    rng = random.Random(8)
    for text in ("".join(rng.choice("日本語中文的是") for _ in range(500)), "".join(rng.choice("aZ9+/kQ=") for _ in range(3000)), "=" * 700, "  " * 90 + "a"):
        parts = vocabulary.chunks_of(text)
        assert "".join(parts) == text
        for a, b in itertools.pairwise(parts):
            near = (a[-vocabulary.longest :], b[: vocabulary.longest])
            for i, j in itertools.product(range(1, len(near[0]) + 1), range(1, len(near[1]) + 1)):
                assert (near[0][-i:] + near[1][:j]).encode() not in set(vocabulary.of_id)


def test_piece_columns(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (0, "a b"), (4, "the then there " * 40), (5, "the then there " * 40), (4, "the then there " * 40)]
    out = piece_sampling.decode_column(piece_sampling.encode_column(H.documents(spark, rows).withColumn("_body", F.lit(1))))
    got = out.collect()
    assert all(r.decoded == r.text for r in got) and "_body" in out.columns
    by = {}
    for r in got:
        by.setdefault((r.doc_id or 0, r.text), set()).add(str(r.piece_ids))
    assert all(len(v) == 1 for v in by.values()) and by[4, rows[4][1]] != by[5, rows[4][1]]


def test_chat(spark):
    rng = random.Random(7)
    alphabet = ["[INST]", "[/INST]", "</s>", "\\", "[\\INST]", "<\\\\/s>", "a", "\n", " ", "é", "🎉", "["]
    rows = [(c, t, rng.choice(("user", "assistant", "system", None)), None if rng.random() < 0.1 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(100, 0, "assistant", "long " * 40_000), (None, 0, "assistant", "x"), (101, 0, "user", "same"), (101, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))
    got = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((t, role or "", text or "") for c, t, role, text in rows if c == conv)
        assert chat_format.read_turns(r.formatted) == [x[1:] for x in own]
        said = chat_format.masked_texts(r.formatted, r.token_start, r.token_end, r.loss_mask)
        assert said == [x[2] for x in own if x[1] == "assistant" and x[2]]
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_is_a_stream_of_bounded_batches(spark):
    encoder = chat_format.load_encoder(chat_format.tokenizer_file())
    longest = []

    class Watched:
        def encode(self, text, **more):
            longest.append(len(text))
            return encoder.encode(text, **more)

    # One batch of Spark with many conversations, the last of them very long.
    rows = [(c, "user" if t % 2 else "assistant", f"turn {t} of {c}") for c in range(2500) for t in range(2)]
    rows += [(9999, "assistant" if t % 2 else "user", "words " * 200) for t in range(2000)]
    given = pa.RecordBatch.from_pylist([dict(zip(("conv_id", "role", "text"), r, strict=True)) for r in rows])
    out = list(chat_format.encode_turns(iter([given]), Watched(), 50_000))
    assert max(longest) < 1300 and max(len(b) for b in out) <= chat_format.BATCH_ROWS
    assert max(sum(map(len, b.column("formatted").to_pylist())) for b in out) <= chat_format.BATCH_CHARS + 52_000
    pieces = [(r["piece"], len(r["formatted"])) for b in out for r in b.to_pylist() if r["conv_id"] == 9999]
    assert len(pieces) > 40 and [p for p, _ in pieces] == list(range(len(pieces))) and max(n for _, n in pieces) < 52_000
    # Pieces tell what whole conversations tell, and have the tokens of the whole text.
    rows = [(c if c else None, t, "assistant" if t % 3 else None, f"</s>[INST] é🎉 {t} " * (t % 7)) for c in range(12) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = chat_format.format_conversations(df)
    cut = chat_format.format_pieces(df, piece_chars=300)
    assert cut.count() > 100
    told = {tuple(r) for r in chat_format.digests(whole).collect()}
    assert len(told) == 12 and told == {tuple(r) for r in chat_format.digests(cut).collect()}
    for r in whole.collect():
        at_once = encoder.encode(r.formatted, add_special_tokens=False)
        assert at_once.ids == r.token_ids and at_once.offsets == list(zip(r.token_start, r.token_end, strict=True))


def test_toxicity_held_out(spark):
    rng = random.Random(9)
    bad = ("zorgplat", "quixmuddle")
    rows = [(i, " ".join(["".join(rng.choice("abcdeou") for _ in range(5)) for _ in range(40)] + ([rng.choice(bad)] if i % 4 == 0 else []))) for i in range(400)]
    docs = H.documents(spark, [*rows, (1000, None), (1001, ""), (1002, "y " * 200_000 + "zorgplat"), (1003, "y " * 200_000)]).withColumn("toxic", F.lit(5))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(7, None), (8, 1), (8, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, labels["doc_id"] % 5 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in rows if i % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.97
    assert got[1000] == got[1001] < 0.5 and got[1002] > 0.5 > got[1003]
    prior = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert {round(r.score, 6) for r in toxicity.score(docs, prior).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_language_gradients():
    rng = np.random.default_rng(3)
    net = language_id.Network.fresh(["a", "b", "c"])
    x, y = rng.integers(0, 256, (4, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, gradient = net.gradients(x, y)
    for p, g in zip(net.params(), gradient, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        step = 1e-5
        p[at] += step
        up, _ = net.gradients(x, y)
        p[at] -= 2 * step
        down, _ = net.gradients(x, y)
        p[at] += step
        assert abs((up - down) / (2 * step) - g[at]) < 1e-4
    p = net.predict(x, net.tables())
    loss = -np.log(p[np.arange(4), y]).mean()
    assert abs(loss - net.gradients(x, y)[0]) < 1e-3


def test_language_held_out(spark):
    rng = random.Random(11)
    tongues = {"aa": "bak lom tir ", "bb": "zuv xeq wyj ", "cc": "éöü ñaç ßîê "}
    rows = [(i, "".join(rng.choice(tongues[t].split(" ")[:3]) + " " for _ in range(rng.randint(3, 120)))) for i, t in ((i, sorted(tongues)[i % 3]) for i in range(240))]
    docs = H.documents(spark, [*rows, (900, None), (901, ""), (902, "12 34 ## 5"), (903, "zuv xeq " * 40_000)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 900, F.element_at(F.array(*map(F.lit, sorted(tongues))), (F.col("doc_id") % 3 + 1).cast("int"))))
    net = language_id.train(docs, docs["doc_id"] % 4 != 2)
    got = {r.doc_id: (r.language.lang, r.language.score) for r in language_id.identify(docs, net).collect()}
    assert np.mean([got[i][0] == sorted(tongues)[i % 3] for i, _ in rows if i % 4 == 2]) > 0.97
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "bb"
    assert language_id.train(docs.limit(0), F.lit(True)) is None
    assert {r.language.lang for r in language_id.identify(docs, None).collect()} == {"und"}


def test_pieces_of_a_run_are_spelled_at_once(monkeypatch):
    import pyarrow as pa

    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.model_file(), piece_sampling.ALPHA)
    texts = ["héllo wörld", "", None, "日本語 text \x00 é", "a" * 5000, " "]
    ids = piece_sampling.Sampler(vocabulary).encode(list(range(6)), [t or "" for t in texts])
    rows = pa.array([None if t is None else i for t, i in zip(texts, ids)], pa.list_(pa.int32()))
    for size in (1, 7, 100_000):
        monkeypatch.setattr(piece_sampling, "SPELLED_PIECES", size)
        speller = piece_sampling.Speller(vocabulary)
        assert speller.texts(rows).to_pylist() == texts
        assert speller.texts(rows[2:5]).to_pylist() == texts[2:5] and speller.texts(rows[:0]).to_pylist() == []
    assert speller.texts(rows).to_pylist() == [None if t is None else piece_sampling.decode(i, vocabulary) for t, i in zip(texts, ids)]
