"""The text operators against brute force, exact round trips and held-out labels, on small tables."""

import gzip
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwell.llm import boosting, fingerprints, jaccard, language, mixing, packing, pii, quality, recount, toxicity, warc
from ledgerwell.llm.queries import TOKENIZER
from ledgerwell.llm.shared import prepared
from ledgerwell.llm.tokens import ChunkEncoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, _key string, score double"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


def texts():
    base = sentence(1, 120)
    return [
        (0, base), (1, base), (2, base.replace("alpha", "omega", 1)), (3, sentence(2, 90)), (4, ""), (5, None), (6, "  \n\t"),
        (7, "one"), (8, "Don't, 12.5 É é 日本 <|endoftext|>"), (9, sentence(3, 6000)), (9, "again the same id"), (None, "no id here"), (10, sentence(2, 90)),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    rows = [(i, t, "en" if (i or 0) % 2 else None, [None, "a", "b"][(i or 0) % 3], len(t or ""), 1, "k", 0.5) for i, t in texts()]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ids_of(text):
    return [*ChunkEncoder.of(TOKENIZER).tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_tokenizers():
    odd = ["ÀB..!c d1e2", "İx Σς ΟΔΟΣ, ß ẞ", "a b\x1cc\td e\r\n", "a  b\n\n c ", "<|endoftext|> x", "'s don't CAN'T 'll"]
    for text, raw in zip(odd, ChunkEncoder.of(TOKENIZER).encode(odd), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)[:-1]


def test_plan_equals_one_bin_at_a_time():
    rng = np.random.default_rng(5)
    for _ in range(60):
        capacity = int(rng.choice([10, 30, 64]))
        items = rng.integers(1, capacity + 1, rng.integers(1, 60)).tolist()
        left, bins = Counter(items), Counter()
        while left:
            held, gap = [], capacity
            while fits := [x for x, n in left.items() if n > 0 and x <= gap]:
                held.append(max(fits))
                left[held[-1]] -= 1
                gap -= held[-1]
            if gap and len(held) > 1:
                room, some = gap + held[-1], [x for x, n in left.items() if n > 0]
                pairs = [(a + b, a, b) for a in some for b in some if b <= a and (a != b or left[a] > 1) and held[-1] < a + b <= room]
                if pairs:
                    left[held.pop()] += 1
                    held += max(pairs)[1:]
                    left.subtract(max(pairs)[1:])
            bins[tuple(sorted(held))] += 1
            left = +left
        planned = Counter()
        for held, times in packing.plan_bins(Counter(items), capacity):
            planned[tuple(sorted(held))] += times
        assert planned == bins


def test_packing_places_all_tokens_once(docs, empty):
    rows = packing.pack_documents(docs, TOKENIZER, 64, ids=True).collect()
    assert sum(r["length"] for r in rows) == sum(len(ids_of(t)) for _, t in texts())
    placed = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in placed.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    whole = [x for r in sorted((r for r in rows if r["doc_id"] == 0), key=lambda r: r["piece"]) for x in r["ids"]]
    assert whole == ids_of(texts()[0][1])
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_fingerprints_follow_jaccard(docs, empty):
    rows = fingerprints.edited_fingerprints(docs).collect()
    ordered = sorted(((i, t or "") for i, t in texts()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = {}
    for nth, (i, t) in enumerate(ordered):
        edited = fingerprints.edit_text(t, ordered[(nth + 1) % len(ordered)][1])
        want[i, len(t)] = hashlib.sha256(edited.encode()).hexdigest()
    assert {(r["doc_id"], r["n_chars"]): r["edited_sha256"] for r in rows} == want and len(rows) == len(ordered)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["fingerprint"] == by_id[1]["fingerprint"] and by_id[0]["near_next"] == 1.0
    assert by_id[1]["near_next"] == pytest.approx(jaccard_of(texts()[1][1], texts()[2][1], 5), abs=0.1)
    assert fingerprints.edited_fingerprints(empty).count() == 0


def shingles_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard_of(a, b, width):
    x, y = shingles_of(a, width), shingles_of(b, width)
    return len(x & y) / len(x | y)


def brute_groups(rows, width, parts, whole):
    sets = [(i, shingles_of(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and whole * len(a & b) >= parts * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize("width,parts,whole", [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_jaccard_groups_equal_all_pairs(spark, width, parts, whole):
    prepared(spark)
    rng, rows = np.random.default_rng(7), []
    for family in range(12):
        words = rng.integers(0, 10_000, int(rng.choice([3, 8, 25, 120, 400]))).tolist()
        for _ in range(int(rng.integers(1, 9))):
            words = list(words)
            for at in rng.integers(0, len(words), rng.integers(0, 3)):
                words[at] = int(rng.integers(0, 10_000))
            rows.append((len(rows), " ".join(f"W{x}" for x in words)))
    rows += [(len(rows), ""), (len(rows) + 1, None)]
    got = jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), width, parts, whole).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(rows, width, parts, whole)


def test_jaccard_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET_SETS", 3)
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 4)
    test_jaccard_groups_equal_all_pairs(spark, 3, 9, 10)


def test_jaccard_keeps_all_rows(docs, empty):
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_groups(docs, 3, 9, 10).collect())
    assert sum(got.values()) == len(texts()) and got[1, 0] == 1 and got[10, 3] == 1 and got[4, 4] == 1
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([0, 3, 4, 5, 6, 7, 8, 9, None])
    assert jaccard.one_of_each_group(empty).count() == 0


def test_jaccard_decides_repeated_ids_by_text(spark):
    prepared(spark)
    one, two, three = (sentence(n, 100) for n in (21, 22, 23))
    near = lambda t: t + " tail"
    rows = [(2, three), (3, one), (9, near(one)), (9, two), (9, two.upper()), (9, two), (12, near(two)), (15, near(three)), (15, "alone here"), (20, ""), (20, ""), (None, two)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_groups(frame).collect())
    assert got == Counter([(2, 2), (3, 3), (9, 3), (9, 9), (9, 9), (9, 9), (12, 9), (15, 2), (15, 15), (20, 20), (20, 20), (None, 9)])
    kept = Counter((r["doc_id"], (r["text"] or "").lower()) for r in corpus_pipeline.drop_near_copies(spark, frame, "").collect())
    assert kept == Counter([(2, three), (3, one), (9, two), (15, "alone here"), (20, ""), (20, ""), (None, two)])


def test_keys_meet_wherever_sets_link():
    rng = np.random.default_rng(9)
    for parts, whole in ((9, 10), (4, 5)):
        for _ in range(150):
            n = int(rng.integers(5, 300))
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            drop = int(rng.integers(0, max(1, n * (whole - parts) // whole) + 1))
            b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 62, drop // 2).astype(np.uint64))))
            if jaccard._similar(a, b, parts, whole) and len(np.setxor1d(a, b)):
                assert np.intersect1d(jaccard.keys_of(a, parts, whole), jaccard.keys_of(b, parts, whole)).size


def test_mixing_meets_targets(spark, empty):
    prepared(spark)
    rows = [(i, " ".join(["w"] * (i % 37)), [None, "b", "a", "ä"][i % 4 if i % 3 else 1]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(frame).collect()
    sizes, taken, goal = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        goal[r["source"]] = r["target"]
    weights = dict(zip(["a", "b", "ä", None], [3, 1, 2, 3], strict=True))
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(weights)
    while open_:  # fix those above, share again
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            want |= share
            break
        want |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    for s in weights:
        assert goal[s] == pytest.approx(want[s], abs=1e-3) and abs(taken[s] - want[s]) <= 80
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mixed_rows(frame).count() == sum(r["copies"] for r in got)


def test_recount_equals_encoding_anew(docs, empty):
    encoder = ChunkEncoder.of(TOKENIZER).tokenizer
    rows = recount.edited_counts(docs, TOKENIZER).collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert r["n_tokens"] == len(encoder.encode(r["text"], add_special_tokens=False).ids)
    assert recount.edited_counts(empty, TOKENIZER).count() == 0


def test_random_edits():
    encoder, rng = ChunkEncoder.of(TOKENIZER), np.random.default_rng(2)
    for _ in range(30):
        text = sentence(int(rng.integers(1000)), int(rng.integers(0, 200)))
        tree = recount.TokenTree.build([text], encoder)[0]
        for _ in range(12):
            start, end = sorted(rng.integers(0, len(text) + 1, 2).tolist())
            new = str(rng.choice(["", "x", " y ", "\n", sentence(4, 90), "ab cd"]))
            end = min(end, start + 40)
            want = text[:start] + new + text[end:]
            text, _ = tree.edit(text, start, end, new, encoder)
            assert text == want and tree.chars[1] == len(text)
            assert tree.total == len(encoder.tokenizer.encode(text, add_special_tokens=False).ids)


def base_spans(text):
    def luhn(d):
        doubled = [int(x) * (1 + i % 2) for i, x in enumerate(reversed(d))]
        return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_pii_base_and_redaction(spark, empty):
    prepared(spark)
    rng = np.random.default_rng(4)
    parts = ["a.b@c.d-e.fr", "@", "x@y", " ", ".", "1.2.3.4", "999.1.1.1", "0001.2.3.004", "4111 1111-1111 1111", "+1 (377) 555-0271", "+", "é", "12", "\n", "-", "4111111111111112", "_", "a@b.c_d@e.f", "1" * 25]
    rows = [(i, "".join(rng.choice(parts, int(rng.integers(0, 12))))) for i in range(300)] + [(300, None), (301, "7" * 20_000), (302, "q" * 20_000 + "@")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digests(frame).collect()}
    for i, text in rows:
        want = base_spans(text or "")
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (text, got[i])
        assert not want or set(want.split(",")) <= set(got[i]["spans"].split(","))
    one = spark.createDataFrame([(1, "é mail a@b.cd now +1 (377) 555-0271.", 5), (2, None, 1), (1, "é mail a@b.cd now +1 (377) 555-0271.", 5)], "doc_id long, text string, _key int")
    assert [r["text"] for r in pii.redact(one.drop("_key")).orderBy("doc_id").collect()] == ["é mail [EMAIL] now [PHONE]."] * 2 + [None]
    assert pii.digests(empty).count() == 0


def test_pii_adds_masked_addresses(spark):
    prepared(spark)
    rows = [(i, f"ask user{i} [at] mail{i} (dot) com, please") for i in range(300)] + [(300, "to john [at] mail [dot] com"), (301, "é -a.b-(at)c-.d e"), (302, "meet (at) noon")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digests(frame).collect()}
    assert got[300]["spans"] == "email:3:27" and got[300]["n_email"] == 0 and got[300]["n_added"] == 1
    assert got[301]["spans"] == "email:2:15" and got[302]["spans"] == ""
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(frame).collect()}
    assert redacted[300] == "to [EMAIL]" and redacted[7] == "ask [EMAIL], please" and redacted[301] == "é [EMAIL] e"


def test_pii_proposes_numbers_of_many_groups(spark):
    prepared(spark)
    card = "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"
    rows = [(1, "call +33 1 23 45 67 89 1234567 now"), (2, f"pay {card} 77777777"), (3, "no 1 - 2  3   4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0"), (4, "9" * 25 + " 1")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["f_kind"], r["start"], r["end"]) for r in pii.candidates(pii.match_rows(frame)).collect()}
    assert {(1, 3, 5, 22), (2, 2, 4, 4 + len(card)), (3, 2, 3, 45)} <= found
    texts_of = dict(rows)
    assert all(texts_of[i][a] in "+(0123456789" and texts_of[i][b - 1].isdigit() for i, _, a, b in found)
    known = [(i, f"call +33 1 23 4{i % 10} 67 {10 + i % 90} now") for i in range(10, 410)]
    known += [(i, f"order 23 45 67 89 12345{10 + i % 90} and 1 23 45 67 89 {1000 + i}") for i in range(410, 810)]
    spans = pii.digests(spark.createDataFrame(rows[:1] + known, "doc_id long, text string")).where("doc_id = 1").first()["spans"]
    assert spans == "phone:5:22"


def test_pii_overlaps_are_settled_best_first(spark):
    prepared(spark)
    # The middle one beats the last and is beaten by the first: the last stays.
    rows = [(1, 5, "card", 0, 10, 0.9), (1, 5, "card", 5, 15, 0.8), (1, 5, "card", 10, 20, 0.7), (1, 5, "phone", 30, 40, 0.9), (1, 5, "card", 30, 40, 0.9), (None, 5, "card", 5, 15, 0.1), (1, 6, "card", 12, 20, 0.5)]
    rng = np.random.default_rng(8)
    rows += [(2, n // 40, "card", int(a), int(a + rng.integers(1, 12)), float(rng.integers(1, 4))) for n, a in enumerate(rng.integers(0, 60, 400))]
    want, kept = set(), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[5], r[4] - r[3], -r[3], r[2], r[4]), reverse=True):
        if not any(a < r[4] and b > r[3] for a, b in kept[r[:2]]):
            kept[r[:2]].append((r[3], r[4]))
            want.add(r[:5])
    got = [tuple(r) for r in pii.best_apart(spark.createDataFrame(rows, "doc_id long, _key long, kind string, start long, end long, p double")).collect()]
    assert set(got) == want and len(got) == len(want) and (1, 5, "card", 10, 20) in want


def test_boosting_learns_an_interaction():
    x = np.array([[a, b] for a in range(2) for b in range(2)])
    pos, neg = np.array([1.0, 95, 80, 1]), np.array([99.0, 5, 20, 99])
    p = boosting.scores(boosting.fit(x, pos, neg), x)
    assert p[1] > 0.8 and p[2] > 0.6 and p[0] < 0.1 and boosting.threshold(p, pos, neg, 0.8, 10) is not None
    assert boosting.threshold(p, pos, neg, 0.99, 10) is None


def test_toxicity(spark, empty):
    prepared(spark)
    rows = [(i, sentence(i, 60) + (" You MOR0N, idiоt!" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(400)]
    rows += [(400, None, 0), (401, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(frame.drop("toxic"), frame.select("doc_id", "toxic").where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r["_score"] for r in toxicity.score(frame, model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows)
    assert toxicity.fold("1D1OT іdіot, fｏo 12 don't!") == "idiot idiot  foo 12 don't" or "idiot" in toxicity.fold("1D1OT")
    machine = toxicity.automaton([("trash ", 5.0)])
    assert toxicity.evidence("trash can", machine)[0] == 0 and toxicity.evidence("trash", machine)[0] == 5
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.learn(empty, frame.select("doc_id", "toxic").where("false"))[0] == []


def test_toxicity_keeps_a_long_tail_of_terms(spark):
    prepared(spark)
    # 300 terms of abuse of unlike beginnings, each in 8 of 2400 toxic texts and in no other.
    letters = "bcdfghjklm"
    abuse = [f"{letters[n // 100]}{letters[n // 10 % 10]}{letters[n % 10]}zq" for n in range(300)]
    rows = [(n, f"{sentence(n % 50, 20)} {n} {abuse[n % 300]}", 1) for n in range(2400)]
    rows += [(n, f"{sentence(n % 50, 20)} {n}" + (" rare" if n < 2403 else ""), 0) for n in range(2400, 12000)]
    rows += [(n, f"{sentence(n, 20)} odd", 1) for n in range(12000, 12003)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labelled = toxicity.labelled_texts(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    learned = {term.strip() for term, _ in toxicity.learn_lexicon(labelled)}
    assert set(abuse) <= learned and not learned & {*WORDS, "rare", "odd"}


def test_language(spark, empty):
    prepared(spark)
    rng = np.random.default_rng(3)
    sounds = {"aa": ["ba", "bo", "lu"], "bb": ["ki", "ze", "th"], "cc": ["ño", "ra", "ix"]}
    rows = [(i, " ".join("".join(rng.choice(sounds[lang], 3)) for _ in range(30)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(900, None, "aa"), (901, "123 --", "bb"), (902, "", None), (903, "ba" * 700_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.profiles(frame.where("doc_id % 4 <> 2"))
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(frame, learned).collect()}
    assert all(got[i] == lang for i, _, lang in rows[:120])
    assert [got[i] for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert language.predict(empty, learned).count() == 0 and language.predict(frame, learned.where("false")).count() == len(rows)


def page_rows():
    long = "<p>" + "x" * 1200
    return [(1, "http://a", long), (2, "http://b\r\nX: y", long), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", long), (7, "u", "WARC/1.1\r\nWARC-Type: x\r\n\r\n\r\n\r\né" * 40)]


def test_warc_round_trip(spark, tmp_path):
    prepared(spark)
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), 3)
    got = {warc_id(r): r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert len(got) == len(page_rows()) and all(r["problem"] is None for r in got.values())
    for page, _, html in page_rows():
        data, r = (html or "").encode(), got[page]
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert r["record_type"] == ("revisit" if page == 1 else "response") and (page == 1 or bytes(r["payload"]) == data)
    assert got[1]["refers_to"] == "<urn:page:2>"
    assert warc.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    sizes = [10, 20_000, 90_000, 200_000, 300_000, 9_000_000, 0, 40_000]
    rows = [(i, f"http://x/{i}", f"<{i}>" + "a\r\n\r\n" * (n // 5)) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame([*rows, (None, None, None)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"), file_bytes=1 << 20)
    files = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert sorted(n > (1 << 20) + 8 * 1000 for n in files) == [False] * (len(files) - 1) + [True]
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert all(r["problem"] is None for r in got)
    read = {warc_id(r): bytes(r["payload"]).decode() for r in got}
    assert read == {i: html for i, _, html in rows} | {None: ""}


def warc_id(row):
    m = re.match(r"<urn:page:(\d+)>", row["record_id"] or "")
    return int(m[1]) if m else None


def record(n, payload=b"hello"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress])
def test_salvage_recovers_what_follows_damage(pack):
    members = [pack(record(n, b"payload %d " % n * 20)) for n in range(6)]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0xFF
    data = b"junk" + members[0] + members[1] + bytes(broken) + members[3] + members[4][:-30] + members[5]
    if pack is gzip.compress:
        data = data[4:]
    found = list(warc.salvage(data))
    assert [r["record_id"] for _, _, r, _ in found if r] == [f"<urn:page:{n}>" for n in (0, 1, 3, 5)]
    gaps = [(at, n) for at, n, r, _ in found if not r]
    assert sum(n for _, n in gaps) + sum(n for _, n, r, _ in found if r) == len(data) and len(gaps) == (2 if pack is gzip.compress else 3)


def noisy(n):
    return record(n, np.random.default_rng(n).bytes(3000))


def recovered(data):
    return [int(r["record_id"][10:-1]) for _, _, r, _ in warc.salvage(data) if r]


@pytest.mark.parametrize("level", [0, 9])
def test_salvage_keeps_what_passes_inside_a_member(level):
    records = [noisy(n) for n in range(60)]
    bad = records[30][:-400] + b"?" + records[30][-399:]
    rest = [n for n in range(60) if n != 30]
    data = gzip.compress(b"".join([*records[:30], bad, *records[31:]]), level)
    found = list(warc.salvage(data + gzip.compress(noisy(99), level)))
    assert [r["record_id"] for _, _, r, _ in found if r] == [f"<urn:page:{n}>" for n in [*rest, 99]]
    assert [g for g in found if not g[2]] == [(0, len(data), None, "payload does not match its digest")]
    # A cut one, a damaged one and one of a wrong checksum, each with a good one behind it.
    whole, last = gzip.compress(b"".join(records), level), gzip.compress(noisy(99), level)
    cut = whole[: len(whole) // 2]
    assert recovered(cut) == list(range(len(recovered(cut)))) and len(recovered(cut)) in (29, 30)
    assert recovered(cut + last) == recovered(cut) + [99]
    broken = bytearray(whole)
    broken[-6] ^= 1
    assert recovered(bytes(broken) + last) == [*range(60), 99]
    assert [p for _, _, r, p in warc.salvage(bytes(broken) + last) if not r] == ["broken member"]


@pytest.mark.parametrize("part", [0.002, 0.3, 1.0])
def test_threshold_is_the_exact_quantile(spark, part):
    rng = np.random.default_rng(5)
    for values in ([], [0.25], [1.5] * 40, [*rng.normal(size=3000).tolist(), *[-0.5] * 900, 1e-300, 1e9, -1e-300, None]):
        known = sorted(v for v in values if v is not None)
        wanted = known[max(1, math.ceil(len(known) * part)) - 1] if known else None
        frame = spark.createDataFrame([(v,) for v in values], "score double")
        assert quality.quantile(frame, part) == quality.quantile(frame.repartition(7), part) == wanted


def test_quality_counts_and_verdicts(spark, empty):
    prepared(spark)
    rows = [(i, sentence(i, 80)) for i in range(60)] + [(i, " ".join(f"junk{i}x{j}" for j in range(80))) for i in range(60, 80)]
    rows += [(100, "a b c\na b c\n\na b c\n#*<"), (101, " ".join(WORDS[:9] * 4)), (102, None), (103, sentence(1, 4000)), (None, sentence(5, 40))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.range(0, 50).withColumnRenamed("id", "doc_id")
    got = {r["doc_id"]: r for r in quality.judge(frame, trusted).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[n : n + 8]) for n in range(len(words) - 7)]
        often = Counter(windows)
        covered = {n + k for n, w in enumerate(windows) if often[w] > 1 for k in range(8)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
    assert not any(got[i]["kept"] for i in range(60, 80)) and sum(got[i]["kept"] for i in range(50)) >= 48
    assert quality.judge(empty, trusted).count() == 0
