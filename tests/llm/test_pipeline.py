"""The pipeline's stages on a small table, each against a brute-force version on its own input."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from loam.llm import queries as Q
from loam.llm.pii_surrogates import detect
from tests.llm.test_small import components, fingerprint, kept_words, quality, texts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PLANTED = [
    (200, "Write to jane.roe@mail.example.com about the plan that we made for the long week ahead of us all, or call +1 (319) 555-5132."),
    (201, "The same jane.roe@mail.example.com wrote another quite different text about the garden and its many trees in spring."),
    (202, "Home | About | News | Contact | Login | Help"),
    (203, "A clean document of plain words that says what it says, once, and then is done with it.\nAll rights reserved."),
    (204, "Ünïcode wörds ünd móre wörds för thé tést, så thât löwer bytes âre nöt enough ït seems tö me."),
]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage, the input first."""
    root = tmp_path_factory.mktemp("pipeline")
    rows = [(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate([*texts(), *PLANTED])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(root / "documents.parquet"))
    docs = spark.read.parquet(str(root / "documents.parquet"))
    out = [docs]
    for name, stage in P.STAGES:
        stage(spark, out[-1], str(root)).write.parquet(str(root / name))
        out.append(spark.read.parquet(str(root / name)))
    return [df.collect() for df in out], str(root)


def test_columns(stages):
    for rows in stages[0][1:-1]:
        assert list(rows[0].asDict()) == COLUMNS
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality_stage(stages):
    before, after = stages[0][0], stages[0][1]
    ids = {r.doc_id for r in after}
    assert not ids & {r.doc_id for r in before if quality(r.text)[5]}
    assert 202 not in ids and {200, 201, 203, 204} <= ids
    by = {r.doc_id: r.text for r in after}
    assert "rights reserved" not in by[203] and by[204] == PLANTED[4][1]


def test_simhash_stage(stages):
    before, after = stages[0][1], stages[0][2]
    want = components([r.doc_id for r in before], [fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for c in want})
    text = {r.doc_id: r.text for r in before}
    assert all(r.text == text[r.doc_id] for r in after)


def test_simhash_rows_of_one_id(spark):
    """Each component keeps a row, also where rows of one id are in several components."""
    one, two, three = (PLANTED[k][1] for k in (0, 3, 4))
    rows = [(1, one), (5, one), (5, two), (6, two), (7, three), (7, PLANTED[1][1]), (7, three), (8, three), (None, "no id at all"), (9, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in P.simhash_dedup(spark, df, "").collect())
    assert got == Counter([(1, one), (5, two), (7, three), (7, PLANTED[1][1]), (None, "no id at all"), (9, None)])


def test_substring_stage(stages):
    before, after = stages[0][2], stages[0][3]
    want = {i: (n, k) for i, _, n, k in kept_words([(r.doc_id, r.text) for r in before], 13)}
    text = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        lost, kept = want[r.doc_id]
        assert r.text == (kept if lost else text[r.doc_id])
    assert any(n for n, _ in want.values())


def test_pii_stage(stages):
    before, after = stages[0][3], stages[0][4]
    new = {r.doc_id: r.text for r in after}
    assert len(after) == len(before)
    for r in before:
        found = detect(r.text)
        if not found:
            assert new[r.doc_id] == r.text
        assert all(r.text[a:b] not in new[r.doc_id] for a, b, _, _ in found)
    mail = [re.search(r"\S+@\S+?(?=[\s,]|$)", new[i])[0] for i in (200, 201)]
    assert mail[0] == mail[1] != "jane.roe@mail.example.com"


def test_packing_stage(stages):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(Q.tokenizer_path("word_bpe_49k.json"))
    docs, pieces = stages[0][4], stages[0][5]
    ids = {r.doc_id: np.array(tok.encode(r.text, add_special_tokens=False).ids + [1], "<u4") for r in docs}
    covered, windows = Counter(), defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
        covered[p.doc_id] += p.length
        windows[p.sequence_id].append((p.offset, p.length))
    assert covered == {i: len(x) for i, x in ids.items()}
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at == 2048 or at & at - 1 == 0


def test_run_is_the_last_stage(spark, stages):
    got = P.run(spark, stages[1])
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[0][5]))
