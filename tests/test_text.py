"""Sections, references, citations, running lines and pages on texts written for them."""

from pyspark.sql import functions as F

from weftgraph.functions.html import to_markdown
from weftgraph.operators import cleaning, html, text

PAPER = """# Title
See [1](#bib.bib1) and Fig. 2 for more. Another et al. [2](#bib.bib2) idea. Last one.

```
# not a heading
```
## 1 Method
A bro-
ken word é-
é here.
### 1.1 Part
text
## Acknowledgements
thanks
## References
- [bib.bib1] Doe. arXiv:2401.12345v2 first
  goes on 10.1234/abc.d1.
- [bib.bib2] Roe.

## A Details
more
"""


def _frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def _cleaned(spark, value, **options):
    return cleaning.cleaned(_frame(spark, value), ["id"], "text", **options).first()


def test_sections(spark):
    found = cleaning.sections(_frame(spark, PAPER), ["id"], "text").orderBy("sec_no").collect()
    assert [(s["heading_level"], s["title"]) for s in found] == [
        (1, "Title"), (2, "1 Method"), (3, "1.1 Part"), (2, "Acknowledgements"), (2, "References"), (2, "A Details")
    ]
    assert found[2]["section_path"] == ["Title", "1 Method", "1.1 Part"] and found[3]["section_path"] == ["Title", "Acknowledgements"]
    assert found[1]["subtree_end"] == found[3]["start_line"] and found[0]["subtree_end"] == len(PAPER.split("\n"))
    jumps = "before\n### Deep\n# Top\n### Skips\n## Two\n"
    paths = cleaning.sections(_frame(spark, jumps), ["id"], "text").orderBy("sec_no").collect()
    assert [(r["sec_no"], r["heading_level"], r["section_path"]) for r in paths] == [
        (0, 0, []), (1, 3, ["Deep"]), (2, 1, ["Top"]), (3, 3, ["Top", "Skips"]), (4, 2, ["Top", "Two"])
    ]


def test_clean(spark):
    found = _cleaned(spark, PAPER)
    assert "broken word éé here" in found["text"] and "thanks" not in found["text"] and "Doe" not in found["text"] and "more\n" not in found["text"][-6:]
    assert "[1](#bib" not in found["text"] and "See 1 and" in found["text"]
    assert [(e["key"], e["arxiv_id"], e["doi"]) for e in found["references"]] == [("bib.bib1", "2401.12345", "10.1234/abc.d1"), ("bib.bib2", None, None)]
    assert found["references"][0]["raw"] == "Doe. arXiv:2401.12345v2 first goes on 10.1234/abc.d1."
    assert [c.asDict() for c in found["references"][0]["citing"]] == [{"sentence": "See 1 and Fig. 2 for more.", "section": "Title"}]
    assert found["references"][1]["citing"][0]["sentence"] == "Another et al. 2 idea."
    assert found["removed"] == {"acknowledgements": 2, "references": 5, "appendix": 3, "appendix_tokens": 6}
    kept = _cleaned(spark, PAPER, drop_appendix=False)
    assert "A Details\nmore" in kept["text"] and "appendix" not in kept["removed"]
    assert _cleaned(spark, "")["flags"] == ["removed 0.0% of tokens (< 2%)", "no reference entries found"]
    most = _cleaned(spark, "# T\nfew\n# References\n" + "many more words here\n" * 9)
    assert most["flags"] == ["removed 93% of tokens (> 50%)"]


def test_appendices(spark):
    text = "# T\n## Intro\na\n## Appendix\nb\n### Sub\nc\n## B More\nd\n## Plain\ne\n"
    found = _cleaned(spark, text)
    assert found["text"] == "# T\n## Intro\na\n## Plain\ne\n" and found["removed"]["appendix"] == 6
    # what follows the references is an appendix, whatever it is called, unless it stands below their level
    after = _cleaned(spark, "# T\n## References\n[1] x\n## Funding\nf\n## Plain\ne\n# Other\ng")
    assert after["text"] == "# T\n" and after["removed"] == {"references": 2, "acknowledgements": 2, "appendix": 4, "appendix_tokens": 7}


def test_reference_forms(spark):
    entries = "## References\n[1] One\n[2] Two\n  more\n\nplain entry\nstill plain\n\n* bulleted\n### Part\ngoes on"
    keyed = "## References\n- [bib.bib7] One\n\nafter a blank line\n- [bib.bib9] Two"
    found = cleaning.references(_frame(spark, entries, keyed), ["id"], "text").orderBy("id", "entry_no").collect()
    assert [(e["id"], e["entry_no"], e["key"], e["raw"]) for e in found] == [
        (0, 1, "1", "One"), (0, 2, "2", "Two more"), (0, 3, "3", "plain entry still plain"), (0, 4, "4", "bulleted goes on"),
        (1, 1, "bib.bib7", "One after a blank line"), (1, 2, "bib.bib9", "Two"),
    ]
    cited = "# T\nAs in [1, 3–4]. Not [9]. " + "Again [2]. " * 12 + "\n" + entries
    citing = {e["key"]: [c["sentence"] for c in e["citing"]] for e in _cleaned(spark, cited)["references"]}
    assert citing["1"] == citing["3"] == citing["4"] == ["As in [1, 3–4]."] and citing["2"] == ["Again [2]."] * 10


def test_sentences(spark):
    text = "See e.g.  This. And [a b. C](#bib.bib3) too. (Then) one! End"
    rows = cleaning.sentences(_frame(spark, text, "", None), ["id"], "text").orderBy("id", "sentence_no").collect()
    assert [r["sentence"] for r in rows] == ["See e.g. This.", "And [a b. C](#bib.bib3) too.", "(Then) one!", "End", ""]


def test_running_lines(spark):
    lines = []
    for page in range(8):
        lines += ["Running header of the paper", f"text {page} a", f"text {page} b", str(page + 1), ""]
    lines.append("arXiv:2401.12345v1 [cs.IR] 3 Jan 2024")
    found = _cleaned(spark, "\n".join(lines))
    assert found["removed"]["repeated_lines"] == 17
    assert found["text"].split() == [w for line in lines if line.startswith("text") for w in line.split()]


def test_texts_stay_apart_and_odd_rows_give_defined_results(spark):
    rows = [(1, "# A\nx", "k"), (1, "# A\nx", "k"), (1, "# B\ny", "k"), (None, "z", "k"), (2, None, "k"), (3, "w " * 300_000, "k")]
    df = spark.createDataFrame(rows, "id int, text string, k string").withColumn("line", F.lit(1)).withColumn("sec_no", F.lit("x"))
    found = cleaning.cleaned(df, ["id"], "text").collect()
    assert sorted((r["id"] or 0, r["text"][:5]) for r in found) == [(0, "z\n"), (1, "# A\nx"), (1, "# B\ny"), (3, "w w w")]
    assert cleaning.sections(df, ["id"], "text").count() == 4
    assert cleaning.cleaned(df.limit(0), ["id"], "text").count() == 0


def test_operators(spark):
    header = "\n".join(f"A header that repeats\nbody {i}\n{i}" for i in range(1, 9))
    df = spark.createDataFrame([(1, header), (2, None), (3, ""), (4, "x" * 500_000)], "id bigint, text string")
    assert [tuple(r) for r in text.repeated_lines(df, ["id"], "text").collect()] == [(1, "A header that repeats", 8)]
    assert [tuple(r) for r in text.page_number_runs(df, ["id"], "text").collect()] == [(1, 8)]
    joined = df.limit(1).select(text.rejoined(F.lit("é-\né a-\nb")), text.citation_numbers(F.lit("1, 3-5, 7-90")))
    assert tuple(joined.first()) == ("éé ab", [1, 3, 4, 5])


PAGE = """<html><head><title>no</title></head><body><nav>menu</nav><article class="ltx_document">
<h1 class="ltx_title ltx_title_document">The <i>Title</i></h1><div class="ltx_authors">A. Uthor</div>
<div class="ltx_abstract"><h6 class="ltx_title_abstract">Abstract</h6><p>Some <math alttext="x^2">x</math> text <b>unclosed</p></div>
<p>Cite <a href="#bib.bib1">1</a>, <a href="http://x">site</a>.<img src="a.png"><p>Next &amp; last
<table><tr><th>a</th><th>b</th></tr><tr><td></td><td></td></tr><tr><td>1<table><tr><td>in</td></tr></table></td><td>2</td></tr></table>
<section class="ltx_bibliography"><h2>Refs</h2><ul><li class="ltx_bibitem" id="bib.bib1"><span class="ltx_tag">[1]</span>
Doe. <span class="ltx_bib_cited">Cited</span></li></ul></section></article><footer>end</footer></body></html>"""


def test_pages(spark):
    title, found = to_markdown(PAGE)
    assert title == "The Title"
    for part in ("# The *Title*", "## Abstract", "$x^2$", "[1](#bib.bib1), site.", "Next & last", "a | b\n1 in | 2", "## References", "- [bib.bib1] [1]. Doe."):
        assert part in found, part
    for part in ("Uthor", "menu", "end", "Cited", "a.png", "http"):
        assert part not in found
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>" * 5000 + "deep")], "id int, html string")
    out = {r["id"]: r["markdown"] for r in html.pages_to_markdown(df, ["id"], "html").collect()}
    assert set(out) == {1, 3, 4} and out[3] == "\n" and "deep" in out[4]
    kept = html.worth_keeping(html.pages_to_markdown(df, ["id"], "html"), least_words=5)
    assert [r["id"] for r in kept.collect()] == [1]
