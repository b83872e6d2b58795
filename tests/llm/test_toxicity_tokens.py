"""Every letter is read: words joined by punctuation, markup or nothing, and unspaced scripts."""

import pytest

from cardwatch.llm import common, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))


def test_tokens_cover_all_letters():
    cutter = toxicity.Cutter(["idiot", "loser", "losers"])
    assert cutter.tokens("a/Idiot/b <p>x</p> foo_idiot,42") == ["a", "Idiot", "b", "p", "x", "p", "foo", "idiot", "42"]
    assert cutter.tokens("youIDIOTyoulosersabc") == ["you", "IDIOT", "you", "losers", "abc"]
    assert cutter.tokens("x" * 33) == ["x" * 14, "x" * 14, "x" * 5]
    assert cutter.tokens("你好idiot世界人民大") == ["你好", "idiot", "世界人民", "大"] and cutter.tokens(None) == cutter.tokens(" .. ") == []
    for text in ("Ünïcödé ÀÈ× 𝒳𝒴 一二三四五六", "İİİİİİİİİİİİİİİİİİ idiot", "año2024ñ_мир"):
        assert "".join(cutter.tokens(text)) == "".join(c for c in text if c.isalnum() or c == "×")
    whole = toxicity.Cutter()
    assert whole.tokens("youidiotyouloser") == ["youidiotyoulos", "er"]


def test_joined_toxic_words_are_found(model, spark):
    word, other = "idiot", "loser"
    toxic = [f"you pathetic {word} {other}", f"a/{word}/b x/{other}/y", f"<p>{word}</p><b>{other}</b>", f"foo_{word},{other}",
             f"you{word}you{other}", f"你好{word}世界{other}人民"]
    clean = ["a quiet day by the sea", "a/quiet/b x/day/y", "<p>quiet</p><b>day</b>", "foo_quiet,day", "youquietyoudayandnight", "你好quiet世界day人民", "", None]
    tagger = toxicity.Tagger(model)
    score = lambda texts: [round(float(x), 3) for t, _, _ in tagger.totals(texts) for x in tagger.doc_score(t)]
    assert min(score(toxic)) >= 0.7 and max(score(clean)) < 0.3, (score(toxic), score(clean))
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(toxic)], "doc_id long, text string")
    for r in toxicity.score(rows, model).collect():
        marked = "".join(r["text"][s["start"]:s["end"]] for s in r["toxic_spans"])
        assert word in marked and other in marked and r["is_toxic"]


def test_clean_windows_come_from_the_whole_text():
    cutter = toxicity.Cutter()
    text = " ".join(f"w{k}" for k in range(5_000))
    starts = {int(toxicity.windows(f"{text} end{d}", 0, frozenset(), cutter)[k][0][0][1:]) for d in range(40) for k in range(3)}
    assert len(starts) > 60 and max(starts) > 4_000 and min(starts) < 1_000
    assert toxicity.windows("one two", 0, frozenset(), cutter) == [(["one", "two"], [0, 0])] and toxicity.windows(" ", 1, frozenset(), cutter) == []


def test_the_document_score_is_that_of_its_marginals(model):
    import numpy as np

    tagger = toxicity.Tagger(model)
    text = "some words and then you pathetic idiot loser and more words"
    totals, p = tagger.block([text, None])
    top, amount, n = float(p.max()), float(p[p > 0.2].sum()), len(p)
    assert np.allclose(totals[0], [top, amount, n]) and totals[1].tolist() == [0, 0, 0]
    x = [1.0, np.log(top / (1 - top)) / 5, np.log1p(amount), np.sqrt(amount / n)]
    assert np.isclose(tagger.doc_score(totals)[0], 1 / (1 + np.exp(-np.dot(model.doc, x))))
