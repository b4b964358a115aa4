import zlib

import numpy as np

from strata.llm import kernel, language


def slices(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def brute(text):
    """The bundle by its definition: every trigram's bound, permuted letter vectors, summed."""
    v, letters, run = language._vectors().astype(np.int64), language._letters(), [0]
    for ch in text:
        s = int(letters[ord(ch)])
        if s or run[-1]:
            run.append(s)
    if run[-1]:
        run.append(0)
    out = np.zeros(language.DIM)
    for a, b, c in zip(run, run[1:], run[2:]):
        if b:
            out += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return out


def test_bundles_by_definition():
    texts = ["", "a", "The river, the STONE!", "  été  größe 12 ñandú", "日本語 テキスト 😀 x", "!!", "no"] * 2
    got, letters = language.bundles(*slices(texts))
    assert letters.tolist()[:7] == [0, 1, 16, 13, 8, 0, 2]
    for g, t in zip(got, texts):
        assert np.array_equal(g, brute(t)), t
    group = np.array([0, 1] * 7)
    per, _ = language.bundles(*slices(texts), group, 2)
    assert np.array_equal(per[1], sum(brute(t) for t in texts[1::2]))


def test_held_out_accuracy_and_odd_rows(spark, small_dir, odd_docs, odd_rows, no_docs):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = language.train_and_identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    got = language.train_and_identify(odd_docs).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (100, 101, 102))
    assert language.train_and_identify(no_docs).count() == 0


def test_nothing_learned(spark, odd_docs):
    none = language.learn_profiles(odd_docs.where("lang = 'xx'").select("text", "lang"))
    assert {r.lang_pred for r in language.identify(odd_docs, none).collect()} == {"und"}


def test_long_text_in_parts(monkeypatch):
    text = "the river and the stone " * 3000
    whole, _ = language.bundles(*slices([text, "x"]))
    assert np.array_equal(whole[0], brute(text))
    assert kernel.CHUNK > 0
