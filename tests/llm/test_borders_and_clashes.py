"""Block borders change nothing, columns may be called like helpers, and workers remember within bounds."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwell.llm import jaccard, language, pii, tokens, toxicity
from ledgerwell.llm.shared import free_name, prepared

HELPERS = ("_key", "_steps", "_row", "_row_key", "_hash", "_of", "_copy", "_id", "_score", "_words", "_evidence", "_density", "_n", "_island")
SENTENCE = "the quick brown fox jumps over the lazy dog while nine other words go on number {}"
SMALL = "/root/testdata/sf0.001"


def texts_of(letters, times, joined=""):
    dice = random.Random(7)
    return [joined.join(dice.choice(letters) for _ in range(dice.randint(0, 40))) for _ in range(times)]


def test_language_blocks_change_nothing():
    for text in texts_of("ab Σé-1.\n", 200):
        codes, n = language.counted(text)
        for block in (1, 2, 3, 7):
            again, times = language.counted(text, block)
            assert codes.tolist() == again.tolist() and n.tolist() == times.tolist()
    codes, n = language.counted("word " * 250_000)
    assert len(codes) == 13 and n.max() == 250_000


def test_profiles_do_not_depend_on_batches(spark):
    rows = spark.createDataFrame([(t, "xx") for t in texts_of("ab Σé-1.\n", 60)], "text string, lang string")
    held = lambda df: {(r["code"], r["place"]) for r in language.profiles(df, 20).collect()}
    assert held(rows.coalesce(1)) == held(rows.repartition(7)) and len(held(rows)) == 20


def test_toxicity_blocks_change_nothing(monkeypatch):
    machine = toxicity.automaton([("trash ", 5.0), ("scum", 3.0)])
    whole = toxicity._blocks
    for text in texts_of(["trash", "can", "scum", "line", "pond", "тrash", "5cum", "a.b", ""], 200, " "):
        total, words = toxicity.evidence(text, machine)
        for size in (1, 2, 3, 6):
            with monkeypatch.context() as patch:
                patch.setattr(toxicity, "_blocks", lambda t, size=size: whole(t, size))
                assert toxicity.evidence(text, machine) == (pytest.approx(total), words)


@pytest.mark.parametrize("before", range(0, 14))
def test_exceptions_across_a_block_border(before):
    machine = toxicity.automaton([("trash ", 5.0)])
    filler = ("x" * 7 + " ") * (toxicity._BLOCK // 8)
    text = filler[before:] + "trash can and trash"
    assert toxicity.evidence(text, machine)[0] == 5.0


def test_free_name():
    assert free_name("_score", ["a"]) == "_score" and free_name("_score", ["_SCORE", "__score"]) == "___score"


def clashing(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    return frame.select("*", *[F.lit(f"mine {name}").alias(name) for name in HELPERS])


ROWS = [
    (1, SENTENCE.format("one"), "a", "en", 10),
    (2, SENTENCE.format("one"), "a", None, 10),
    (2, SENTENCE.format("one"), None, "en", None),
    (3, "write to ann@example.org or call +44 20 7946 0958", "b", "en", 49),
    (4, None, "b", "en", None),
    (None, "", None, None, None),
    (None, "write to ann@example.org", "b", None, 24),
]


def kept_as_they_were(df, names):
    return all(r[name] == f"mine {name}" for r in df.collect() for name in names)


def test_redaction_keeps_clashing_columns(spark):
    docs = clashing(prepared(spark), ROWS)
    done = pii.redact(docs)
    assert done.columns == docs.columns and kept_as_they_were(done, HELPERS)
    shown = sorted((str(r["doc_id"]), r["text"]) for r in done.where("text like 'write%'").collect())
    assert shown == [("3", "write to [EMAIL] or call [PHONE]"), ("None", "write to [EMAIL]")]
    assert done.count() == len(ROWS) and done.where("text is null").count() == 1


def test_near_copies_keep_clashing_columns(spark):
    docs = clashing(prepared(spark), ROWS)
    done = jaccard.without_near_copies(docs)
    assert done.columns == docs.columns and kept_as_they_were(done, HELPERS)
    assert sorted(str(r["doc_id"]) for r in done.collect()) == ["1", "3", "4", "None", "None"]


def test_scores_keep_clashing_columns(spark):
    docs = clashing(prepared(spark), ROWS)
    model = ([("quick ", 9.0)], (4.0, -2.0))
    with pytest.raises(ValueError):
        toxicity.score(docs, model, keep=docs.columns)
    done = toxicity.score(docs, model, keep=docs.columns, name="mark")
    assert done.columns == [*docs.columns, "mark"] and kept_as_they_were(done, HELPERS)
    assert {str(r["doc_id"]) for r in done.where("mark > 0.7").collect()} == {"1", "2"}


@pytest.mark.parametrize("rows", [ROWS, []], ids=["rows", "empty"])
def test_stages_with_clashing_columns(spark, rows):
    docs = clashing(prepared(spark), rows)
    for name, work in corpus_pipeline.STAGES[:-1]:
        done = work(spark, docs, SMALL)
        assert done.columns == docs.columns, name
        assert kept_as_they_were(done, HELPERS), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.count() == len(rows)


def test_encoder_remembers_within_bounds(monkeypatch):
    from ledgerwell.llm.queries import TOKENIZER

    encoder = tokens.ChunkEncoder(str(TOKENIZER))
    words = texts_of("abcdefgh", 3000)
    blobs = ["0a1b" * 500 + str(i) for i in range(30)]
    texts = [" ".join(words[i : i + 10]) + " " + blobs[i % 30] for i in range(0, 3000, 10)]
    expected = [tokens.np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(tokens, "GROUP_CHARS", 4000)
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 20_000)
    assert list(encoder.encode(texts)) == expected
    last = {c for c in encoder.memo if len(c) > tokens.LONGEST_REMEMBERED}
    assert len(last) <= 3 and not any(len(c) > tokens.LONGEST_REMEMBERED for c in encoder.memo.older)
    assert len(encoder.memo) + len(encoder.memo.older) < len(set(words))


def test_encoder_learns_a_wide_vocabulary_once(monkeypatch):
    from ledgerwell.llm.queries import TOKENIZER

    encoder = tokens.ChunkEncoder(str(TOKENIZER))
    texts = [" ".join(f"{i}x" for i in range(at, at + 1000)) for at in range(0, 200_000, 1000)]
    first = list(encoder.encode(texts))
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda chunks: (learned.append(len(chunks)), learn(chunks)))
    assert list(encoder.encode(texts)) == first and not learned


def test_the_first_word_of_a_text_counts():
    machine = toxicity.automaton([("trash ", 5.0)])
    found = {text: toxicity.evidence(text, machine) for text in ("trash", "trash trash x", "trash can trash", "a trash")}
    assert found == {"trash": (5.0, 1), "trash trash x": (10.0, 3), "trash can trash": (5.0, 3), "a trash": (5.0, 2)}
