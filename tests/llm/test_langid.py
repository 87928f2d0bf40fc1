import pytest
from pyspark.sql import functions as F

from subtally.llm import langid
from subtally.llm.queries import op1_language_id
from tests.llm.texts import HARD


def test_held_out_accuracy_on_whole_documents(spark, sf_dir):
    found = op1_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    share = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    assert found.filter("score < 0 OR score > 1").count() == 0


@pytest.fixture
def labelled(documents):
    words = {"de": "der die und nicht ein haus straße", "en": "the of and not one house street", "fr": "le la et pas une maison été"}
    rows = []
    for k in range(120):
        lang = sorted(words)[k % 3]
        own = words[lang].split()
        rows.append((k, " ".join(own[(k * 7 + j * (k % 5 + 1)) % 7] for j in range(12)), lang, 0.5))
    rows += [(900, None, "de", 0.1), (901, "12 34", "en", 0.1), (902, "unlabelled", None, 0.1), (0, rows[0][1], "de", 0.5)]
    return documents(rows, "doc_id bigint, text string, lang string, score double", "labelled")


def test_texts_without_letters_and_clashing_columns(documents, labelled):
    model = langid.fit(labelled)
    assert model.languages == ["de", "en", "fr"]
    texts = [None, *HARD, "½ Ⅻ ² 12", "der die und das haus", "the house and the street"]
    docs = documents([(i, t, "zz", "x") for i, t in enumerate(texts)], "doc_id bigint, text string, lang_pred string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        if not any(c.isalpha() for c in text or ""):
            assert found[i] == ("und", 0.0)
        else:
            assert found[i][0] in model.languages and 0 <= found[i][1] <= 1
    assert found[len(texts) - 2][0] == "de" and found[len(texts) - 1][0] == "en"


def test_kernels_are_those_of_gram_sets(labelled):
    def grams(text):
        raw = text.lower().encode()
        return {raw[i : i + n] for n in (1, 2, 3) for i in range(len(raw) - n + 1)}

    model = langid.fit(labelled, langid.Sample(landmarks_per_language=2))
    import numpy as np

    codes = langid.Grams()
    for text in ("Straße und Haus", "a", "ab ab ab"):
        own = codes.of(np.frombuffer(text.lower().encode(), np.uint8))
        assert len(own) == len(set(own.tolist())) == len(grams(text))
    assert model.landmarks.shape[1] == 5  # two a language, but for a row that is there twice


def test_without_labels_everything_is_undetermined(documents):
    docs = documents([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert langid.fit(docs) is None
    assert [tuple(r) for r in langid.identify(docs, None).collect()] == [(1, "und", 0.0)]
    assert langid.identify(docs.limit(0), None).count() == 0


def test_a_repeated_id_takes_one_place_of_the_sample(documents):
    rows = [(7, f"the same house {k}", "en") for k in range(300)] + [(1000 + k, f"a house of number {k}", "en") for k in range(600)]
    docs = documents(rows, "doc_id bigint, text string, lang string", "repeated")
    for most in (10, 600, 601):  # whether the repeated id is among the first or not
        grams = langid.training_grams(docs, langid.Sample(per_language=most, most_texts=most)).collect()
        assert sorted(r.place for r in grams) == list(range(1, most + 1))


def test_rows_without_an_id_are_learned_from(spark, documents, labelled):
    named = langid.fit(labelled)
    unnamed = langid.fit(documents([(None, r.text, r.lang) for r in labelled.collect()], "doc_id bigint, text string, lang string", "unnamed"))
    assert unnamed.languages == named.languages
    texts = documents([(1, "der die und das haus"), (2, "the house and the street")], name="asked")
    assert {r.doc_id: r.lang_pred for r in langid.identify(texts, unnamed).collect()} == {1: "de", 2: "en"}
