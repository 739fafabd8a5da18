"""Raw elements end where the page says, whatever its letters are."""

from refinery.llm import page_text


def test_letters_that_grow_in_lower_case():
    dotted = "İstanbul " * 40
    page = page_text.parse(f"<article><p>{dotted}</p><SCRIPT>if (a<b) x()</Script><p>kept one</p><p>kept two</p></article>")
    assert page.tag[1:] == ["article", "p", "script", "p", "p"]
    assert [r for _, r in page.runs if r] == [dotted, "kept one", "kept two"]
