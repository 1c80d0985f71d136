"""The words that fill the training pages are as many as the parameter says."""

from strataload.llm import htmltext


def test_filling_words_is_a_parameter(spark, monkeypatch):
    given = []
    training_pages = htmltext.training_pages
    monkeypatch.setattr(htmltext, "training_pages", lambda words, count: given.append(len(words)) or training_pages(words, count))
    pages = spark.createDataFrame([(1, "<p>one two three four five six seven</p>")], "page_id long, html string")
    htmltext.fit(pages, htmltext.HtmlSpec(training_pages=20, filling_words=5))
    assert given == [5] and htmltext.HtmlSpec().filling_words == 3000
