"""Alignment, BPE and collocations against the tokenizer libraries and brute force, on small tables."""

import hashlib
import os
import random
import re
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerwell.llm import alignment, bpe, collocations
from ledgerwell.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES
from ledgerwell.llm.shared import documents, prepared

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, ids string, block long, n long, w1 string, score double"
random.seed(5)
NOISE = ["".join(random.choice("ab0 '\n\té日▁.<s>") for _ in range(400)) for _ in range(6)]
TEXTS = [
    None, "", " ", "a", "a b  c\n\n d ", "it's I'LL we've 12.5", "x" * 3000, "aaaa" * 50, "日本語テキスト ١٢٣ ½²", "֋࢏ a",
    "see <|endoftext|>it <|endoftext|><|endoftext|> <s> </s>", "a   b\r\n c", "one ▁two ▁ three", "same text", "same text", *NOISE,
]


def table(spark, texts=TEXTS, langs=("en", None, "de")):
    prepared(spark)
    rows = [(i if i % 5 else 7, t, langs[i % len(langs)], "x", 1, 2, "k", 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_latin_character_falls_as_in_the_library():
    split, encoder = Tokenizer.from_file(BYTE_BPE).pre_tokenizer.pre_tokenize_str, bpe.ByteBpe.of(BYTE_BPE)
    for point in [*range(0x100), *range(0x100, 0xD800, 37), *range(0x10000, 0x30000, 211)]:
        text = f"a{chr(point)}1{chr(point)}! {chr(point)}"
        starts = [span[0] for _, span in split(text)]
        assert encoder.words(text) == [text[a:b] for a, b in pairwise([*starts, len(text)])], hex(point)


@pytest.mark.parametrize("as_text", [False, True])
def test_bpe_equals_the_library(as_text):
    library, mine = Tokenizer.from_file(BYTE_BPE), bpe.ByteBpe(BYTE_BPE, as_text)
    library.encode_special_tokens = as_text
    for text, raw in zip(TEXTS, mine.encode(TEXTS), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids
        assert mine.decode(raw) == library.decode(ids, skip_special_tokens=False)
    ids = [random.randrange(50257) for _ in range(2000)]
    assert mine.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_merges_out_of_order_go_one_place_at_a_time():
    # "bc" is made after "abc" could use it, so the lowest pair may appear late.
    letters = {letter: i for i, letter in enumerate(bpe.byte_letters())}
    vocab = letters | {"abc": 256, "bc": 257, "aa": 258}
    rounds = bpe.PairRounds(vocab, [["a", "bc"], ["a", "a"], ["b", "c"]])
    assert not rounds.all_at_once
    assert np.frombuffer(rounds.encode([b"aabc"])[0], "<u4").tolist() == [258, 257]
    assert rounds.encode([b"", b"abc"])[0] == b""


def test_memo_forgets_by_bytes():
    mine = bpe.ByteBpe(BYTE_BPE)
    mine.memo.most = 2000
    first, again = list(mine.encode(TEXTS)), list(mine.encode(TEXTS))
    assert first == again and mine.memo.held < 2_000_000
    assert not any(len(word) > bpe.LONGEST_REMEMBERED for word in mine.memo)


def test_bpe_tables(spark):
    docs = table(spark)
    encoded = bpe.encode_documents(docs, BYTE_BPE)
    back = bpe.decode_documents(encoded, BYTE_BPE)
    assert sorted_rows(back) == sorted_rows(docs.selectExpr("doc_id", "coalesce(text, '')"))
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        wanted.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert sorted_rows(bpe.digests(docs, BYTE_BPE)) == sorted(wanted, key=repr)
    assert bpe.digests(docs.limit(0), BYTE_BPE).collect() == []


def aligned_by_brute_force(rows):
    """Rows of ``align`` from all token pairs of each text."""
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a.encode_special_tokens = True
    code = {letter: i for i, letter in enumerate(bpe.byte_letters())}
    docs, counts = [], Counter()
    for doc_id, text in rows:
        spaced = " " + (text or "")
        ids_a = a.encode(spaced, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != spaced.encode() or b"".join(bytes_b) != spaced.encode():
            docs.append((doc_id, [], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        starts_a, starts_b = np.concatenate(([0], ends_a[:-1])), np.concatenate(([0], ends_b[:-1]))
        overlaps = (starts_a[:, None] < ends_b) & (starts_b < ends_a[:, None])
        links = [(ids_a[i], ids_b[j]) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(overlaps)))]
        groups, at, bt = [], 0, 0
        for end in sorted({*ends_a.tolist()} & {*ends_b.tolist()}):
            to_a, to_b = ends_a.tolist().index(end) + 1, ends_b.tolist().index(end) + 1
            groups.append(",".join(map(str, ids_a[at:to_a])) + "|" + ",".join(map(str, ids_b[bt:to_b])))
            at, bt = to_a, to_b
        docs.append((doc_id, ids_a, ids_b, links, ";".join(groups)))
        counts.update(links)
    highest = Counter()
    for (_, piece), n in counts.items():
        highest[piece] = max(highest[piece], n)
    for doc_id, ids_a, ids_b, links, groups in docs:
        best, total = sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        yield doc_id, len(ids_a), len(ids_b), groups.count(";") + bool(groups), len(links), digest, best, total


def test_alignment_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 500)
    docs = table(spark)
    wanted = sorted(aligned_by_brute_force(docs.select("doc_id", "text").collect()), key=repr)
    assert sorted_rows(alignment.align(docs, BYTE_BPE, PIECE_BPE)) == wanted
    assert alignment.align(docs.limit(0), BYTE_BPE, PIECE_BPE).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the provided tables")
def test_queries_equal_brute_force(spark):
    rows = documents(spark, SF_DIR).select("doc_id", "text").where("length(text) < 4000").collect()
    ids = {row[0] for row in rows}
    counts_aside = {row["doc_id"]: row for row in QUERIES["op11_alignment"](spark, SF_DIR).collect()}
    for doc_id, n_a, n_b, n_groups, n_links, digest, _, _ in aligned_by_brute_force(rows):
        got = counts_aside[doc_id]
        assert (got["n_a"], got["n_b"], got["n_groups"], got["n_links"], got["groups_sha256"]) == (n_a, n_b, n_groups, n_links, digest)
    library = Tokenizer.from_file(BYTE_BPE)
    encoded = {row["doc_id"]: row for row in QUERIES["op12_bpe"](spark, SF_DIR).collect()}
    for doc_id, text in rows:
        raw = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert encoded[doc_id]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert encoded[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert ids <= encoded.keys() and len(encoded) == documents(spark, SF_DIR).count()


def collocations_by_brute_force(rows, least, top, share=50):
    found = {}
    for lang, text in rows:
        counts = found.setdefault(lang or "und", Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                counts.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for phrase, a in candidates.items():
            inside = (t for t in candidates if len(t) > len(phrase) and phrase in (t[:2], t[1:]))
            if any(100 * candidates[t] >= share * a for t in inside):
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        total = sum(n for p, n in f.items() if len(p) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "top", "trigger"), [(2, 30, 2), (3, 2000, 1), (5, 2000, 24)])
def test_collocations_equal_brute_force(spark, least, top, trigger):
    draw = random.Random(7)
    words = ["New", "york", "York", "the", "of", "ü", "日本", "x-y"]
    made = ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ; "]) for _ in range(60)) for _ in range(30)]
    made += ["a a a a a a a a a", "A a\ta  a", "new york city " * 40, "  lead and trail  ", *TEXTS]
    docs = table(spark, made)
    wanted = collocations_by_brute_force([(r["lang"], r["text"]) for r in docs.collect()], least, top)
    got = collocations.collocations(docs, least=least, top=top, trigger=trigger, bits=1 << 12)
    assert sorted_rows(got) == wanted and wanted


def test_collocations_with_shared_hashes_and_no_rows(spark, monkeypatch):
    docs = table(spark, ["b c d " * 12, "b c e " * 12])
    whole = collocations.WordHashes.__call__

    def clashing(self, data, starts, ends):
        # With the first seed "d" and "e" look alike; the second hash of a word still tells them apart.
        return whole(self, np.where(data == ord("e"), ord("d"), data).astype(np.uint8) if self.seed == 1 else data, starts, ends)

    monkeypatch.setattr(collocations.WordHashes, "__call__", clashing)
    block = collocations.Block(["x"], [b"d e"], np.array([False]), np.array([1]), collocations.WordHashes(1))
    assert block.word[0] == block.word[1]
    monkeypatch.undo()
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(table(spark, [None, "", "rare words"])).collect() == []


def test_runs_of_chunks_are_encoded_as_one_text(monkeypatch):
    aligner = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    rng = random.Random(7)
    odd = ["", " ", "   ", "a", "don't", "'s", "x ", " y", "a b", "\n", "b\n", "\nc", "a\nb", "\tq", "12", "é", "日本", "!?", "<|endoftext|>", "  d", "e  ", "\x1cz", "z\x1d"]
    for n in (0, 1, 2, 50, 400):
        chunks = [rng.choice(odd) + rng.choice(["", "", "w", "7", "."]) for _ in range(n)]
        alone = list(aligner.a.encode(" " + c for c in chunks))
        ids, sizes = aligner._encode_a(chunks)
        assert sizes.tolist() == [len(raw) // 4 for raw in alone]
        assert ids.astype("<u4").tobytes() == b"".join(alone)
    given = []
    encode = aligner.a.encode
    monkeypatch.setattr(aligner.a, "encode", lambda texts: (given.append(kept := list(texts)), encode(kept))[1])
    list(aligner.align([" ".join(f"word{i}" for i in range(500))]))
    assert [len(texts) for texts in given] == [1]
