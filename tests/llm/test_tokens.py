"""Operators 11 to 13 against the libraries and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from terrace.llm import align, pieces, trie

SF = "/root/testdata/sf0.001"
PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
SNIPPETS = [" ", "  ", "     ", "\n", "\n\n", "\t", "\r", "▁", "▁▁", "a", "the", " the", "ing", "s", "é", "é", "ﬁ", "中文", "😀", "\xa0", " ", "　", "\x1c", "\x85", "\x00", "<s>", "</s>", "<0x41>", "<unk>", "<|endoftext|>", "'s", "'ll", "1", "12", "…", ".", "--", "==" * 40, "word " * 30]


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=PIECES)


def texts(rng, n):
    out = [None, "", " ", "   ", "x" * 3000, "ab " * 2000, " " * 500, "퟿"]
    for _ in range(n):
        if rng.random() < 0.3:
            out.append("".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(32, 400)])) for _ in range(rng.randrange(1, 12))))
        else:
            out.append("".join(rng.choice(SNIPPETS) for _ in range(rng.randrange(1, 14))))
    return out


def test_pieces_are_the_library_s(model):
    rng, p = random.Random(11), pieces.pieces(PIECES)
    some = [" ".join(rng.choice(p.vocabulary.names) for _ in range(rng.randrange(1, 6))) for _ in range(3000)]
    for t in [*texts(rng, 3000), *some, *["".join(rng.choice(p.vocabulary.names[259:]) for _ in range(rng.randrange(1, 6))) for _ in range(3000)]]:
        ids = model.encode(t or "")
        assert p.encode(t).tolist() == ids and p.decode(np.array(ids, "<u4")) == model.decode(ids), repr(t)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(270), rng.randrange(32000), 28705, 259]) for _ in range(rng.randrange(8))]
        assert p.decode(np.array(ids, "<u4")) == model.decode(ids), ids


def test_pairs_are_compatible_where_merging_says_so():
    rng, v = random.Random(3), pieces.pieces(PIECES).vocabulary
    usable = [i for i in v.ids.values() if v.left[i] is not None]
    for _ in range(20_000):
        a, b = rng.choice(usable), rng.choice(usable)
        merged = [x[0] for x in v.merged([*v.names[a], *v.names[b]])]
        assert v.compatible(a, b) == (merged == [v.names[a], v.names[b]])


def test_stretches_forget_and_stay_right(model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_STRETCHES", 6)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 3)
    p, rng = pieces.Pieces(PIECES), random.Random(2)
    for t in texts(rng, 300):
        assert p.encode(t).tolist() == model.encode(t or "")
    assert len(p.known) <= 3


def test_sentencepiece_query(spark, model):
    from terrace.llm.pieces import op11_sentencepiece

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op11_sentencepiece(spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = model.encode(docs[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())


def test_encode_and_decode_keep_columns(spark, model):
    rows = [(1, None, "a"), (None, "", "b"), (1, "same", None), (1, "same", None), (2, "x\ny", "decode me")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded_text string")
    got = pieces.decode(pieces.encode(df, begin=False, keep_text=True)).collect()
    assert sorted(map(str, got)) == sorted(str(spark_row) for spark_row in got) and len(got) == 5
    for r in got:
        want = model.encode(r["text"] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*want, 2] and r["decoded"] == model.decode(want)
    assert pieces.encode(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pieces.encode(df.withColumnRenamed("decoded_text", "ids"))


def aligned(docs, model):
    """Brute force: (n_a, n_b, groups, links) of each text, and the counts of pairs."""
    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    a_bytes, out, counts = align.byte_contents(BYTES), [], Counter()
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    b_bytes = [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    for t in docs:
        a, b = (whole.encode(" " + t, add_special_tokens=False).ids, model.encode(t)) if t else ([], [])
        want = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            out.append((0, 0, [], []))
            continue
        ends = [dict(zip(np.cumsum([len(c[i]) for i in ids]).tolist(), range(1, len(ids) + 1))) for c, ids in ((a_bytes, a), (b_bytes, b))]
        groups, links, p, q = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            groups.append((a[p : ends[0][e]], b[q : ends[1][e]]))
            p, q = ends[0][e], ends[1][e]
            links.append((a[p - 1], b[q - 1]))
        counts.update(links)
        out.append((len(a), len(b), groups, links))
    return out, counts


def test_alignment_against_brute_force(spark, model):
    docs = texts(random.Random(5), 400) + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    docs += docs[-3:]
    want, counts = aligned(docs, model)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(docs)], "doc_id long, text string, links string, __row int").repartition(7)
    got = {r["doc_id"]: r for r in align.align(df).collect()}
    assert len(got) == len(docs)
    for i, (n_a, n_b, groups, links) in enumerate(want):
        r = got[i]
        assert (r["n_a"], r["n_b"], [tuple(g) for g in r["groups"]]) == (n_a, n_b, groups), docs[i]
        assert (r["n_best"], r["count_sum"]) == (sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
    assert align.align(df.limit(0)).collect() == []
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    assert sorted(str(tuple(r)[0]) + str(r["n_a"]) for r in align.align(rows).collect()) == ["30", "None2", "None2"]


def test_alignment_digest(spark, model):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, _ = aligned([t for _, t in docs], model)
    got = {r["doc_id"]: r for r in align.op12_tokenizer_alignment(spark, SF).collect()}
    for (doc, _), (n_a, n_b, groups, links) in zip(docs, want, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        assert (got[doc]["n_a"], got[doc]["n_b"], got[doc]["n_groups"], got[doc]["n_links"], got[doc]["groups_sha256"]) == (n_a, n_b, len(groups), len(links), digest)


@pytest.mark.parametrize("kept, learnt, written", [(250_000, 1000, 1 << 20), (12, 3, 5)])
def test_stretches_of_both_tokenizers(model, monkeypatch, kept, learnt, written):
    for name, x in (("KEPT_BOTH", kept), ("LEARNT", learnt), ("WRITTEN_TOKENS", written)):
        monkeypatch.setattr(align, name, x)
    rng = random.Random(12)
    words = ["naïve", "l\xa0été", "\xa0", "中文字", "ﬁne", "don't", "'s", "\u200b", "a\u3000b", "x" * 80, "<|endoftext|>", "<s>", "ÿ", "Ωμέγα", "42", "...", "word"]
    docs = texts(rng, 200) + [rng.choice([" ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    both, want = align.Both(BYTES, PIECES), aligned(docs, model)[0]
    for first in range(0, len(docs), 50):
        made = both([None if t is None else t.encode() for t in docs[first : first + 50]])
        for t, (written_groups, packed, n_a, n_b), (a, b, groups, links) in zip(docs[first:], made, want[first:]):
            assert (n_a, n_b) == (a, b) and written_groups.decode() == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), repr(t)
            assert [divmod(x, 1 << 32) for x in np.frombuffer(packed, "<i8").tolist()] == links, repr(t)


def test_new_stretches_are_tokenized_together(monkeypatch):
    both, calls = align.Both(BYTES, PIECES), Counter()
    counted = lambda name, f: lambda *a, **b: calls.update([name]) or f(*a, **b)
    monkeypatch.setattr(both, "latin", counted("latin", both.latin))
    monkeypatch.setattr(both.library, "encode", counted("library", both.library.encode))
    assert len([*both([" ".join(f"w{i}" for i in range(k, k + 500)).encode() for k in range(0, 2000, 500)])]) == 4
    assert len(both.known) == 2000 and max(calls.values()) <= 10


def test_alignment_has_no_interpreted_lambdas(spark, monkeypatch):
    plans, made = [], align.materialize
    monkeypatch.setattr(align, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or made(df, name))
    align.op12_tokenizer_alignment(spark, SF)
    assert plans and not any("lambda" in x for x in plans)


def nodes_by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    out = []
    for node, m in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = lambda x: sum(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids(node), sum(not kids(x) for x in below), sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x), hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("fan, held, block", [(256, 100_000, 14), (2, 3, 1)])
def test_trie_against_brute_force(spark, monkeypatch, fan, held, block):
    for name, x in (("FAN", fan), ("HELD", held), ("BLOCK", block)):
        monkeypatch.setattr(trie, name, x)
    rng, rows = random.Random(13), []
    for c in range(60):
        if rng.random() < 0.15:
            continue
        n = rng.choice([0, 1, 2, 3, 6, 9, 20])
        rows += [(c, rng.choice([None, i, i, 3]), rng.choice(["user", "assistant", None, ""]), rng.choice(["", None, "hi", "ü", "long text"])) for i in range(n)]
    rows += [(c, i, "user", f"copy {i}") for c in (100, 103, 200, 201, 305, 10**12) for i in range(40)]
    rows += [(None, 1, "user", "nobody's"), (7, None, None, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = sorted((tuple(r)[:8] for r in trie.conversation_trie(df).collect()), key=str)
    assert got == nodes_by_hand(rows)
    assert trie.conversation_trie(df.limit(0)).collect() == []


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in trie.op13_conversation_trie(spark, SF).collect()), key=str) == nodes_by_hand(rows)
