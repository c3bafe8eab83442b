from __future__ import annotations

import hashlib
import time
from collections import Counter

import pytest

from tickerloom.llm import chat, html

SCHEMA = "conv_id bigint, turn bigint, role string, text string, position string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


HARD = ["</s>[INST] ok [/INST]", "<<SYS>>\x1b<</SYS>>", "[/[/INST]INST]", "<</s>", "\x1b1</\x1b1s>", "", "é😀\n", "<<ROLE>>"]


def test_formats_and_reads_back(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], t, "p") for k, t in enumerate(HARD)]
    rows += [(2, 0, "system", "be", "p"), (2, 1, "user", None, "p"), (2, 2, "assistant", "yes", "p")]
    rows += [(3, None, "assistant", "x", "p"), (3, 1, "tool", "[ANS]", "p"), (3, 1, "tool", "[ANS]", "p"), (3, 1, None, "n", "p")]
    rows += [(None, 5, "user", "u", "p")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r["conv_id"]: r for r in chat.chat_digests(chat.format_chat(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, r is not None, r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        )
        said = "".join(f"{r}\n{x}\n" for _, _, _, r, x in turns)
        loss = "".join(x for _, _, _, r, x in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha(said))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
        assert r["formatted_chars"] > len(loss)
    assert [got[k]["valid"] for k in (1, 2, 3, None)] == [True, True, False, False]


def test_segments_carry_loss_flags(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", ""), (1, 1, "assistant", "b", "")], SCHEMA)
    turns = chat.format_chat(df).orderBy("position").collect()
    flags = [(s["text"], s["loss"]) for t in turns for s in t["segments"]]
    assert flags == [("[INST]", False), ("a", False), ("[/INST]", False), ("[ANS]", False), ("b", True), ("</s>", False)]


def test_other_template_and_bad_ones():
    template = chat.Template(
        roles={"user": chat.Frame("<u>", "</u>"), "bot": chat.Frame("<b>", "</b>", True)},
        other=chat.Frame("<o>", "</o>"),
        named="<n>",
    )
    formatter = chat.Formatter(template)
    turns = [(r, t) for r in ("user", "bot", "x<n>y", "") for t in [*HARD, "<u></b><n>"]]
    whole = "".join(p for r, t in turns for p, _ in formatter.segments(r, t))
    assert formatter.read(whole) == turns
    for bad in ("<u", "u>", "><", ""):
        with pytest.raises(ValueError):
            chat.Formatter(chat.Template(roles={"user": chat.Frame("<u>", bad)}))


def test_no_conversations(spark):
    assert chat.chat_digests(chat.format_chat(spark.createDataFrame([], SCHEMA))).count() == 0


GOOD = "The words of the article are in this sentence and it is for the reader of the page, with that and more. "
PAGES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a></ul></nav>"
        f"<div class='ad'>Buy</div><article><h1>Head &amp; line</h1><p><b>Bold &lt;x&gt;<br>next<p>{GOOD}</p>"
        f"<script>var a='<p>no</p>';</script><p>Short.</p><form><p>{GOOD}</p></form>"
        f"<div class='reader-comments'><p>{GOOD}</p></div></article><footer>&copy; x</footer>",
        f"Head & line\nBold <x> next\n{GOOD.strip()}\nShort.",
    ),
    "plain": (
        f"<div id=sidebar><p>{GOOD * 3}</p></div><div><p>{GOOD * 3}</p><p>Between.</p><p>{GOOD * 3}</p></div>"
        f"<p><a href=x>{GOOD}</a></p><p>Last bit.</p>",
        f"{(GOOD * 3).strip()}\nBetween.\n{(GOOD * 3).strip()}",
    ),
    "only short": ("<main>Just&nbsp;this</main>", "Just this"),
    "hidden": (f"<main><p style='display: none'>{GOOD}</p><p>a\n\t b</p><!-- <p>c</p> --></main>", "a b"),
    "broken": ("<p", ""),
    "empty": ("", ""),
    "null": (None, ""),
}


def test_main_text():
    for name, (page, want) in PAGES.items():
        assert html.main_text(page) == want, name


def test_layout_classes_do_not_lose_articles():
    body = f"<p>{GOOD * 3}</p><p>{GOOD * 4}</p>"
    whole = f"{(GOOD * 3).strip()}\n{(GOOD * 4).strip()}"
    for page in (
        f'<div style="overflow:hidden">{body}</div>',
        f'<div class="overflow-hidden" title="The hidden cost">{body}</div>',
        f'<body class="page no-sidebar">{body}</body>',
        f'<html class="modal"><body class="sticky-header">{body}</body></html>',
        f'<article class="widget"><section id="related-work">{body}</section></article>',
        f'<form id="page"><div class="widget"><article>{body}</article></div></form>',
        f'<div class="has-sidebar"><div class="promo">{body}</div><p>x</p></div>',
    ):
        assert html.main_text(page) == whole, page
    assert html.main_text(f'<article><h2 class="section-header">Head</h2>{body}</article>') == f"Head\n{whole}"
    for mark in ("hidden", "style='color:red; display:none'", 'aria-hidden="true"', "class='comment-list'"):
        assert html.main_text(f"<article><div {mark}>{body}</div><p>ab</p></article>") == "ab", mark
    long = f"<div class='comments'>{body * 3}</div>"
    assert html.main_text(f"<div>{body}</div>{long}<aside><article>{body}</article></aside>") == whole


def test_neighbours_decide_short_blocks():
    long = f"<p>{GOOD * 3}</p>"
    assert html.main_text(f"{long}<p>mid</p>{long}").count("\n") == 2
    assert "mid" not in html.main_text(f"{long}<p>mid</p><p><a>{GOOD}</a></p>")


def test_extract(spark):
    rows = [(k, "u", page, "x") for k, (page, _) in enumerate(PAGES.values())]
    df = spark.createDataFrame([*rows, rows[0]], "page_id bigint, url string, html string, text string")
    want = Counter((k, "u", t, len(t)) for k, (_, t) in enumerate(PAGES.values()))
    want[(0, "u", PAGES["article"][1], len(PAGES["article"][1]))] += 1
    assert Counter(tuple(r) for r in html.extract(df).collect()) == want
    assert html.extract(df.where("false")).count() == 0


def test_long_and_deep_pages():
    assert html.main_text("<div>" * 20000 + "x" + "</div>" * 20000) == ""
    assert len(html.main_text(f"<article>{'<p>word</p>' * 20000}</article>")) == 20000 * 5 - 1


WORDS = "the keeper of the light was in the tower and it was for the boats that he lit it "


@pytest.mark.parametrize("start", ['<a name="top">', '<a id="x"/>', '<a href="/home">Home</a><a name=top>'])
def test_anchors_that_are_no_links_lose_no_text(start):
    page = f"<body>{start}<article><p>{WORDS * 4}</p><p>{WORDS * 3}</p></article></body>"
    assert (WORDS * 4).strip() in html.main_text(page)


def test_a_link_ends_with_its_block():
    page = f'<body><div><a href="/x">more</div><p>{WORDS * 4}</p></body>'
    assert (WORDS * 4).strip() in html.main_text(page)


def test_articles_in_other_languages():
    text = "смотритель маяка каждый вечер зажигал огонь чтобы лодки видели берег " * 5
    page = f'<body><ul><li><a href="/">главная</a></li></ul><p>{text}</p><p>{text}</p></body>'
    assert html.main_text(page) == "\n".join([text.strip()] * 2)


@pytest.mark.parametrize("piece", ["<a ", "<", "<!--", "<p", "</"])
def test_a_megabyte_of_unclosed_markup_is_quick(piece):
    start = time.time()
    html.main_text(f"<p>{WORDS}</p>" + piece * ((1 << 20) // len(piece)))
    assert time.time() - start < 2
