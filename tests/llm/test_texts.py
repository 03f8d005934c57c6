"""Operators on single texts against plain patterns, libraries and brute force."""

import random
import re
import time
from html import unescape
from pathlib import Path
from string import ascii_letters, ascii_lowercase, digits

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from riskwatch.llm import html_text, pieces, pii, secrets, token_counts, token_output, unigram

MODEL = public_tokenizers.path("piece_bpe_32k.model")
many = settings(max_examples=300, deadline=None)
odd = st.text(alphabet="ab c\n\t▁é世.<>0x", max_size=40)


def plain_pii(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return found


@many
@given(st.text(alphabet="a@.+- ()0123456789é", max_size=60))
def test_base_personal_data_equals_the_patterns(text):
    assert [s for s in pii.find_spans(text) if s[0] in pii.BASE] == plain_pii(text)


@many
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "1.2.3.4", "999.1.1.1", "+1 (499) 555-6503", "a.b@c.de", "@", ".", " ", "x", "7"]), max_size=12))
def test_base_personal_data_equals_the_patterns_in_mixtures(parts):
    text = "".join(parts)
    assert [s for s in pii.find_spans(text) if s[0] in pii.BASE] == plain_pii(text)


def slow_url(text, start, scheme_end):
    """The same rule, read anew for every scheme."""
    rest = re.compile(r"[^\s<>\"'(){}\[\]]+").match(text, scheme_end)
    if rest is None:
        return None
    body = rest.group().rstrip(".,;:!?")
    if text.startswith("//", scheme_end - 2):
        personal = "@" in body.partition("/")[0]
    else:
        personal = "@" in body or sum(map(str.isdigit, body)) >= 7
    return ("url", start, scheme_end + len(body)) if personal else None


@many
@given(st.lists(st.sampled_from(["http://", "mailto:", "tel:", "a@b.c", "/", "1234", "x", ".", ":", " ", "(", "sip:", "@", "99"]), max_size=14))
def test_addresses_equal_a_plain_reading(parts):
    text, found, after = "".join(parts), [], 0
    for m in re.finditer("(?=(https?://|ftp://|mailto:|tel:|sip:))", text):
        span = slow_url(text, m.start(), m.start() + len(m.group(1))) if m.start() >= after else None
        if span:
            found.append(span)
            after = span[2]
    assert [s for s in pii.find_spans(text) if s[0] == "url"] == found


LONG = 1_000_000


@pytest.mark.parametrize("piece", [
    "0", "0.", "http://", "mailto:", "a@", "a@b.", "+1", "+1 ", "1 ", "1-", "iban ", "ssn 123-45-6789 ", "x", "1.2.3.4 ",
    "http://u@h/ ", "tel:123 ", "+1 (2) 3-4.5", "GB82 ", "@", "sip:1",
])
def test_personal_data_takes_linear_time(piece):
    text = piece * (LONG // len(piece))
    begin = time.time()
    spans = pii.find_spans(text)
    assert time.time() - begin < 12
    short = piece * 60
    assert [s for s in pii.find_spans(short) if s[0] in pii.BASE] == plain_pii(short)
    assert all(end <= len(text) for _, _, end in spans)


def test_numbers_of_any_length_are_read():
    zeros = "0" * 5000
    assert pii.find_spans(f"{zeros}1.1.1.{zeros}255") == [("ip", 0, 10009)]
    assert pii.find_spans(f"{zeros}256.1.1.1") == []


def test_added_personal_data_and_masks():
    text = "iban DE89 3704 0044 0532 0130 00 and https://me:pw@host.org/x, mailto:a@b.cd SSN: 123-45-6789."
    kinds = [k for k, _, _ in pii.find_spans(text)]
    assert kinds.count("account") == 2 and kinds.count("url") == 2
    assert pii.mask(text) == "iban [account] and [url], [url] SSN: [account]."
    assert pii.find_spans("iban DE00 3704 0044 0532 0130 00; see https://host.org/x and the ssn 000-12-3456") == []
    assert pii.mask("a@b.cd 10.0.0.1") == "[email] [ip]" and pii.mask(None) is None


def plain_secrets(text):
    found = []
    pattern = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(pattern, text, re.IGNORECASE | re.ASCII):
        if len(m.group(2)) >= 8:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


@many
@given(st.lists(st.sampled_from(["token", "API_key", "pass", "word", "ſecret", "=", ": ", '"', "AKIA", "ABCDEFGH12345678", "deadbeef" * 4, "0f", "x", " "]), max_size=14))
def test_base_secrets_equal_the_patterns(parts):
    text = "".join(parts)
    assert [s for s in secrets.find_spans(text) if s[0] in secrets.BASE] == plain_secrets(text)


def test_novelty_tells_keys_from_names():
    pick = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    hits = misses = 0
    for _ in range(100):
        key = "".join(pick.choice(alphabet) for _ in range(40))
        name = "_".join(pick.choices(secrets.IDENTIFIERS.split(), k=5))
        hits += any(s[0] == "novel" for s in secrets.find_spans(f"set private_key: {key} here"))
        misses += any(s[0] == "novel" for s in secrets.find_spans(f"set private_key: {name} here"))
    assert hits == 100 and misses <= 8


@pytest.mark.parametrize("gap", [1, 40, 150, 190, 230])
def test_a_key_that_stands_twice_is_novel_at_both_places(gap):
    pick = random.Random(gap)
    for _ in range(60):
        key = "".join(pick.choices(ascii_letters + digits, k=40))
        words = " ".join(pick.choices(secrets.IDENTIFIERS.split(), k=60))
        first = f"set private_key: {key} "
        text = f"{words[:150]} {first}{words[150 : 150 + gap]} and session = {key}. {words[-60:]}"
        found = [s[1:] for s in secrets.find_spans(text) if s[0] == "novel"]
        assert [text[a:b].strip(".") for a, b in found] == [key, key]


CODE = Path(random.__file__).read_text()


@pytest.mark.parametrize("length", [16, 32, 40, 64, 128])
@pytest.mark.parametrize("alphabet", [digits, digits + "abcdef", digits + "ABCDEF", ascii_lowercase, ascii_lowercase + digits, ascii_letters + digits + "+/"])
def test_random_keys_in_code_are_novel_in_every_alphabet(alphabet, length):
    pick, found = random.Random(length), 0
    for _ in range(50):
        key = "".join(pick.choices(alphabet, k=length))
        at = pick.randrange(len(CODE) - 400)
        lead = CODE[at : at + 180] + '\nprivate_key = "'
        spans = secrets.find_spans(f'{lead}{key}"\n{CODE[at + 200 : at + 400]}')
        found += ("novel", len(lead), len(lead) + length) in spans
    assert found >= 45


def test_random_strings_are_drawn_from_the_keys_alphabet():
    assert secrets.alphabet_of("0123") == digits and secrets.alphabet_of("ab12") == digits + "abcdef"
    assert secrets.alphabet_of("gh_1.") == ascii_lowercase + digits + "._"
    assert secrets._draws("ab", 20) == secrets._draws("ab", 20)


@pytest.fixture(scope="module")
def library():
    model = unigram.load(MODEL)
    scores = {k: s for k, s in model.pieces.values()}
    vocabulary = [(t, scores.get(k, 0.0)) for k, t in enumerate(model.texts)]
    found = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    found.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return found


def test_pieces_equal_the_library_and_come_back(library):
    pick = random.Random(5)
    texts = ["".join(pick.choices("the of andé 世x\n\t  .ing▁", k=pick.randrange(80))) for _ in range(400)]
    texts += ["  lead", "trail  ", "a  b", " ", "\n", "▁", "世", "naïve café " * 50]
    for text, ids in zip(texts, pieces.encode_texts(texts, MODEL), strict=True):
        got = np.frombuffer(ids, "<i4")
        assert got.tolist() == library.encode(text).ids, text
        assert pieces.decode_ids(got, MODEL) == text.replace("▁", " ")
    assert token_counts.count_tokens(texts, MODEL) == [len(library.encode(t).ids) for t in texts]


@many
@given(odd)
def test_word_paths_share_prefixes_rightly(text):
    whole = pieces.encode_texts([text], MODEL)[0]
    fresh = [pieces.PrefixViterbi(pieces._trie(MODEL), unigram.load(MODEL)).encode(unigram.marked(k)) for k in unigram.marked_words(text)]
    assert np.frombuffer(whole, "<i4").tolist() == [i for ids in fresh for i in ids]


@pytest.fixture(scope="module")
def byte_library():
    found = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    found.encode_special_tokens = True
    return found


@many
@given(st.text(alphabet="ab' s1\n\t\r  é世!", max_size=40))
def test_remembered_words_give_the_whole_texts_ids(byte_library, text):
    words = token_output.encoder(public_tokenizers.path(token_output.TOKENIZER))
    got = np.frombuffer(words.encode([text])[0], words.dtype).tolist()
    assert got == byte_library.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def loaded_library():
    return Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))


@many
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "<|", " ", "one", "two.", "\n", "\t", "é"]), max_size=12))
def test_added_tokens_are_those_of_the_library_as_loaded(loaded_library, parts):
    words, text = token_output.encoder(public_tokenizers.path(token_output.TOKENIZER)), "".join(parts)
    got = np.frombuffer(words.encode([text])[0], words.dtype).tolist()
    assert got == loaded_library.encode(text, add_special_tokens=False).ids


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></ul></nav><div class="cookie-notice">We use cookies.</div>
      <div class="ad">Buy now, it is cheap and good and you will like it a lot, really.</div>
      <article><h1>Head &amp; line</h1><p>One <b>two</b>\n three.<br><p>Four&#233;.<aside>Side</aside><form><input>Mail</form>
      <section id="comments"><p>A reader says a long thing about the article that nobody asked for, at length.</p></section>
      <!-- hidden --><p>Last.</p></article><footer>&copy; me</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line One two three. Fouré. Last."


def test_pages_without_an_element_of_content():
    around = '<nav><ul><li><a href=/>Home</a><li><a href=/b>Books and more</a></ul></nav>{}<div class="ad">Buy now.</div><footer>Me, 2020</footer>'
    lines = ["Who is there?", "I.", "Come in, then.", "No.", "Then stay where you are, and let me sleep."]
    dialogue = "".join(f"<p>{x}</p>" for x in lines)
    long = "There was a house by the river, and an old man lived in it with nobody else but his cat."
    for inside, text in [
        (dialogue, " ".join(lines)),
        ("<h1>The moon</h1><div>O moon,<br>o night,<br>o light.</div>", "The moon O moon, o night, o light."),
        ("<p>Moved.</p>", "Moved."),
        (f"<p>{long}</p>{dialogue}<p>{long}</p>", f"{long} {' '.join(lines)} {long}"),
    ]:
        assert html_text.main_text(f"<html><body>{around.format(inside)}</body></html>") == text
    assert html_text.main_text("a < b &amp; c") == "a < b & c"
    assert html_text.main_text(around.format("")) == ""
    # With an element of content, short blocks outside it stay out.
    assert html_text.main_text(f"<p>Top.</p><article><p>{long}</p></article><p>End.</p>") == long


def changed(page):
    """Blocks that the cut labels otherwise than their own score does."""
    blocks = html_text.blocks_of(page)
    scores, kept = html_text.labels(blocks)
    return [(b.text, k) for b, score, k in zip(blocks, scores, kept, strict=True) if (score > 0) != k]


ARTICLE = "<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>One paragraph of some length is here.</p>{}<p>Another one ends it.</p></article><footer>F</footer>"


@pytest.mark.parametrize("inside", [
    '<p class="alert-box">Kept.</p>', '<p id="legal">Kept.</p>', '<div class="search-tips"><p>Kept.</p></div>',
    '<p><a href="/x">Kept.</a></p>', '<p class="hint">Kept.</p>', '<div class="related-work"><p>Kept.</p></div>', "<p>Kept.</p>",
])
def test_a_weak_sign_alone_loses_no_paragraph(inside):
    text = html_text.main_text(ARTICLE.format(inside))
    assert text == "Title One paragraph of some length is here. Kept. Another one ends it."


@pytest.mark.parametrize("inside", [
    '<div class="ad">Gone.</div>', '<p class="ad">Gone.</p>', '<div class="ad-slot"><p>Gone.</p></div>', "<aside>Gone.</aside>",
    '<section id="comments"><p>{}</p><p>Gone.</p></section>'.format("Gone and long. " * 40), "<form>Gone.<input></form>",
    '<div class="notice">Gone.</div>', '<div class="newsletter-box">Gone.</div>', '<aside><article><p>Gone.</p></article></aside>',
    '<ul class="share"><li><a>Gone</a><li><a>Gone</a></ul>', '<div class="cookie-banner"><p>Gone.</p></div>', "<nav>Gone.</nav>",
])
def test_parts_that_are_no_article_go(inside):
    assert "Gone" not in html_text.main_text(ARTICLE.format(inside))
    assert html_text.main_text(ARTICLE.format(inside)).endswith("here. Another one ends it.")


def test_the_cut_decides_what_scores_leave_open():
    # A linked line alone counts as a menu; between paragraphs it is one of them.
    link = '<p><a href="/x">See the next part.</a></p>'
    assert changed(ARTICLE.format(link)) == [("See the next part.", True)]
    # A line with hardly any sign of its own, between adverts: it goes with them.
    rows = '<div class="content"><div class="ad">Buy.</div><div class="box-alert">Now only today.</div><div class="ad">Buy more.</div></div>'
    page = f"<main><p>{'The text of the page. ' * 9}</p></main>{rows}"
    open_scores = dict(zip([b.text for b in html_text.blocks_of(page)], html_text.labels(html_text.blocks_of(page))[0], strict=True))
    assert abs(open_scores["Now only today."]) < 1.2 and "Now only" not in html_text.main_text(page)


@pytest.mark.parametrize("piece", [
    "<a ", "<a '", '<a "', "<b>", "</i>", "<b></i>", "<!", "<?", "<p>", "<div>", '<a href="x>', "<nav>x</nav><p>y</p>", "&",
    '<div class="ad">x</div><p><a>y</a></p>', "<i><article><b>", "<p>x<a>y</a>", "<svg>", "<![CDATA[", "<a \"'>",
])
def test_broken_pages_take_linear_time(piece):
    for tail in ("", ">"):
        begin = time.time()
        html_text.main_text(piece * (500_000 // len(piece)) + tail)
        assert time.time() - begin < 10
    begin = time.time()
    html_text.main_text("<i><article>" + "<b>" * 100_000 + "</i>" * 100_000)
    assert time.time() - begin < 10


def test_formulas_are_text():
    page = """<article><p>So <math><semantics><mrow><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow>
      <annotation encoding="application/x-tex">a=\\frac12</annotation></semantics></math> holds.<svg><text>Label</text></svg></article>"""
    assert html_text.main_text(page) == "So a = 1 2 holds."


def test_least_cut_is_least():
    pick = random.Random(11)
    for _ in range(60):
        n = pick.randrange(1, 9)
        scores = [pick.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, pick.uniform(0, 1)) for a in range(n) for b in range(a + 1, n) if pick.random() < 0.5]

        def cost(side, scores=scores, edges=edges):
            own = sum(max(0, s) if not x else max(0, -s) for s, x in zip(scores, side, strict=True))
            return own + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert cost(html_text.least_cut(scores, edges)) == pytest.approx(best)


def test_pages_of_the_tables():
    pq = pytest.importorskip("pyarrow.parquet")
    path = Path("/root/testdata/sf0.01/pages.parquet")
    if not path.exists():
        pytest.skip("no driver tables")
    for row in pq.read_table(path).to_pylist():
        inside = re.search(r"<article>(.*)</article>", row["html"], re.DOTALL).group(1)
        text = " ".join(unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inside))).split())
        assert html_text.main_text(row["html"]) == text
