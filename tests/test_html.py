"""The small DOM helper: matching rules the extraction specs rely on."""

from shelfscan.functions.html import parse


def test_class_token_vs_exact_string():
    root = parse('<div class="product-tile">a</div><div class="x product y">b</div>'
                 '<div class="page js-change-page">c</div><div class="page">d</div>')
    assert [n.text() for n in root.find_all("div", "product")] == ["b"]
    assert [n.text() for n in root.find_all("div", "product-tile")] == ["a"]
    # a class given with a blank must equal the whole attribute string
    assert [n.text() for n in root.find_all("div", "page js-change-page")] == ["c"]
    assert [n.text() for n in root.find_all("div", "page")] == ["c", "d"]


def test_nested_matches_both_and_document_order():
    root = parse('<div class="p"><div class="p">in</div>out</div><div class="p">3</div>')
    got = [n.text_tight() for n in root.find_all("div", "p")]
    assert got == ["inout", "in", "3"]


def test_void_elements_and_unclosed_tags():
    root = parse('<div class="t"><img src="a.png"><br><a href="/x">X</a><p>one<p>two</div>'
                 '<div class="t">next</div>')
    tiles = root.find_all("div", "t")
    assert len(tiles) == 2
    assert tiles[0].find("a", None, "href").get("href") == "/x"
    assert tiles[0].find("img").get("src") == "a.png"
    assert tiles[1].text() == "next"


def test_entities_and_attributes():
    root = parse('<div data-j="{&quot;name&quot;: &quot;D&#39;Ouro &amp; co&quot;}">R&amp;D</div>')
    d = root.find("div")
    assert d.get("data-j") == '{"name": "D\'Ouro & co"}'
    assert d.text() == "R&D"
    assert d.get("missing") is None


def test_text_modes_differ():
    root = parse('<div> <span>1,99€</span> / <span>kg </span></div>')
    d = root.find("div")
    assert d.text_tight() == "1,99€/kg"
    assert d.text() == "1,99€ / kg"


def test_script_and_comment_not_text():
    root = parse('<div><script>var t="</p>";</script><!-- c -->keep</div>')
    assert root.find("div").text() == "keep"


def test_end_tag_without_open_is_ignored():
    root = parse('</span><div class="a">x</b>y</div>')
    assert root.find("div", "a").text() == "xy"


def test_next_sibling():
    root = parse('<div><p class="mb-0">H:</p>gap<p>V</p><p>W</p></div>')
    h = root.find("p", "mb-0")
    assert h.next_sibling("p").text() == "V"
    assert root.find("div").next_sibling("p") is None


def test_empty_document():
    assert parse(None).find_all("div") == []
    assert parse("").find("a") is None


def test_valueless_and_duplicate_attributes():
    root = parse('<input disabled name="a" name="b"><div class></div>')
    inp = root.find("input")
    assert inp.get("disabled") == "" and inp.get("missing") is None
    assert inp.get("name") == "b"                      # last duplicate wins
    assert root.find("div").get("class") == ""
    assert root.find("div", "x") is None
