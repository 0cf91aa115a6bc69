"""Cleaning against a plain loop over the same table of patterns with Python's re."""

import re

import pytest
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.operators import cleaning

EDGES = [
    "A (https://doi.org/10.1234/x) b (see 10.99999/q) c", "()", None, "", "( ) x", "NoYesABC", "1999Smith et al", "RNAABC1",
    "x , y .", "a . . b", "...", "?!.,", "Élan et al. 2011 said", "(Smith (2011) inner) out", "no year (Smith) here.",
    "as reviewed in Brown 1999 and by Lee and Park 2005b .", "Smith et al, 2016 or Katayama et al 2014", "É (e.g. Amin 2016) :x",
    "Åberg et al. 2020; Novak et al. 2020", "reviewed by Adams Baker et al. 2001", "abcSmith et  al 2011 RNAXY (", "2011ABC (x)",
    "éSmith 1999", "Smith 1999é", "Smith 1999 x", "tab\tand\nnewline here  (10.12345/z)", "Title Case Words Only Here",
    "YesNo NoNo ProteinABC YesYesXY", "A:B : C", "end . ", "x..y...z", "(Abc 20111) 12 (3456) 78", "Lee and Park 2005 ..",
]


def python_steps(text):
    found = []
    for action, pattern, argument in fv.CITATION_STEPS:
        if action == "take":
            found += [m.group(argument) for m in re.finditer(pattern, text)]
            text = re.sub(pattern, "", text)
        elif action == "put":
            text = re.sub(pattern, argument, text)
        else:
            text = " ".join(text.split())
    return text.strip(), found


def python_links(text):
    found = [m.group(1) for m in re.finditer(fv.LINK_PARENTHESIS, text)]
    for pattern, to in ((fv.LINK_PARENTHESIS, ""), (fv.EMPTY_PARENTHESES, ""), (fv.SPACE_BEFORE_PUNCTUATION, r"\1"),
                        (fv.BLANK_RUN, " ")):
        text = re.sub(pattern, to, text)
    return text.strip(), found


@pytest.fixture(scope="module")
def corpus(spark):
    from notemill.plans.standins import decorated
    rows = decorated(spark, "/root/testdata/sf0.001").select("original_notes").collect()
    return EDGES + [r[0] for r in rows]


def test_citations_equal_python(texts, corpus):
    out = cleaning.remove_citations(texts(corpus), "text", "clean", "found").orderBy("id").collect()
    for row in out:
        if row["text"]:
            assert (row["clean"], row["found"]) == python_steps(row["text"]), row["text"][:200]


def test_links_equal_python(texts, corpus):
    out = cleaning.remove_links(texts(corpus), "text", "clean", "found").orderBy("id").collect()
    for row in out:
        if row["text"]:
            assert (row["clean"], row["found"]) == python_links(row["text"]), row["text"][:200]


def test_notes_join_links_and_citations(texts):
    rows = texts(["A (https://doi.org/10.1234/x) b (Smith 2011).", "plain", "", None], "original_notes")
    out = [tuple(r) for r in cleaning.clean_notes(rows).orderBy("id").select("notes", "only_references").collect()]
    assert out == [("A b.", "10.1234; (Smith 2011)"), ("plain", None), (None, None), (None, None)]


def test_whole_parentheses_on_request(texts):
    out = cleaning.remove_links(texts(["A (see doi.org/q) b"]), "text", "clean", "found", capture="full").first()
    assert (out["clean"], out["found"]) == ("A b", ["(see doi.org/q)"])


def test_many_capitalised_words_do_not_overflow(texts):
    """One match attempt spans tens of thousands of words; recursion per word would end the task."""
    long = "Aa " * 30_000 + "AB et al. 2011 tail reviewed in " + "Bb " * 30_000 + "2012"
    row = cleaning.remove_citations(texts([long]), "text", "clean", "found").first()
    assert row["clean"] == "tail" and len(row["found"]) == 2


def test_filters_on_cleaned_text_stay_cheap(texts):
    """A filter on the result must not copy the chain of steps into itself."""
    out = cleaning.clean_notes(texts(["Jones et al. 2009b x."] * 50, "original_notes"))
    assert out.filter(F.length("notes") > 1).filter(F.col("only_references").isNotNull()).count() == 50


def test_no_citation_is_lost(texts, corpus):
    """Cleaning takes something out of most decorated texts, and what it takes is listed."""
    out = cleaning.clean_notes(texts(corpus[len(EDGES):], "original_notes"))
    assert out.filter("only_references is not null").count() > len(corpus) // 2
