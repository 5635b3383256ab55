from pyspark.sql import functions as F

from ledgerline.llm import language_id

from .conftest import ODD_ROWS

SAID = {
    "en": "the quick brown fox jumps over the lazy dog and then it runs into the forest with all of its friends",
    "de": "der schnelle braune Fuchs springt über den faulen Hund und läuft dann mit allen Freunden in den Wald",
    "fr": "le rapide renard brun saute par dessus le chien paresseux et court ensuite dans la forêt avec ses amis",
}


def evidence(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, declared string, host string")


def corpus(n):
    return [(i, " ".join(SAID[lang].split()[i % 5:]), f"site-{lang}") for i, lang in enumerate(list(SAID) * n)]


def test_held_out_accuracy_and_text(spark, frame):
    rows = corpus(40)
    known = [(i, list(SAID)[i % 3], None) for i in range(60)]
    found = {r.doc_id: r for r in language_id.identify(frame(rows), evidence(spark, known)).collect()}
    assert all(found[i].language == list(SAID)[i % 3] == found[i].text_language for i in range(60, 120))


def test_evidence_adds_up_where_the_text_says_nothing(spark, frame):
    rows = [*corpus(20), (500, None, "site-fr"), (501, "", "x"), (502, "", "x"), (503, "", None)]
    known = [(i, list(SAID)[i % 3], None) for i in range(60)] + [(501, "de", "a.org"), (502, None, "a.de")]
    found = {r.doc_id: r for r in language_id.identify(frame(rows), evidence(spark, known)).collect()}
    assert found[500].language == "fr" and found[500].host == "site-fr", "the host's other texts"
    assert found[501].language == "de", "markup" 
    assert found[502].language == "de", "address suffix"
    assert found[503].confidence < 0.5, "nothing but the corpus"


def test_markup_and_suffix(spark):
    pages = spark.createDataFrame([('<!DOCTYPE html><HTML class=x lang="pt-BR">', "a.B.Fr"), ("<p>", ""), (None, None), ("<html lang=de>", "x")], "html string, host string")
    found = pages.select(language_id.declared_language(F.col("html")), language_id.suffix_of(F.col("host"))).collect()
    assert [tuple(r) for r in found] == [("pt", "fr"), (None, None), (None, None), ("de", "x")]


def test_odd_rows(spark, odd, empty):
    known = evidence(spark, [(3, "en", None), (6, "de", "h.de"), (None, "fr", None), (77, "es", "none")])
    assert sorted(str(r.doc_id) for r in language_id.identify(odd, known).collect()) == sorted(str(i) for i, _, _ in ODD_ROWS)
    nothing = language_id.identify(odd, evidence(spark, [])).collect()
    assert len(nothing) == len(ODD_ROWS) and all(r.language is None and r.confidence is None for r in nothing)
    assert language_id.identify(empty, known).collect() == []
