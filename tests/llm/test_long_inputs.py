"""Inputs that are long in awkward ways: white space, nesting, tags that never end, texts without spaces."""

import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from blotter.llm import byte_bpe, toxicity
from blotter.llm.byte_bpe import encode, load_ranks
from blotter.llm.common import in_one_task, labelled_sample
from blotter.llm.html_blocks import text_blocks
from blotter.llm.html_extract import extract_main_text
from blotter.llm.recurrent_net import new_net, score_texts
from blotter.llm.token_packing import encode_added, load_vocabulary
from blotter.llm.toxicity import stretches, worst_windows
from blotter.llm.warc_derive import derive_records, outlinks, response_records, title
from helpers import docs
from tokenizers import Tokenizer

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WHITE = [" ", "\n", "\t", " \n", "　", "\xa0 ", "\r\n", " "]


# --- white space --------------------------------------------------------

@pytest.mark.parametrize("white", WHITE)
def test_long_white_space_is_encoded_as_the_library_would(white):
    """Runs the library can still encode whole: the same ids, wherever the run stands."""
    multi, plain = load_ranks(RANKS), load_vocabulary(VOCABULARY)
    other = Tokenizer.from_file(VOCABULARY)
    run = white * (6000 // len(white))
    for text in (run, run + "a", "a" + run, f"a{run}b", f"a.{run}'s{run} 1{run}", f"{run}<|endoftext|>{run}x", f"x{run}é中{run}\n"):
        text = text + " pad" * 9000 if len(text) % 2 else "pad " * 9000 + text
        assert encode(multi, text) == multi.encode_ordinary(text)
        assert encode_added(plain, text) == other.encode(text, add_special_tokens=False).ids


def test_runs_are_found_where_the_pattern_splits(monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_RUN", re.compile(f"[{byte_bpe.WHITE}]{{2,}}"))
    monkeypatch.setattr(byte_bpe, "CHUNK_CHARS", 1)
    multi, r = load_ranks(RANKS), random.Random(1)
    for _ in range(3000):
        text = "".join(r.choices([" ", "  ", "\n", "\t", "　", "\x1c", "\x85", "a", "é", "1", ".", "'s", "中"], k=r.randint(2, 14)))
        assert encode(multi, text) == multi.encode_ordinary(text), repr(text)


def test_millions_of_white_space_characters():
    multi, plain = load_ranks(RANKS), load_vocabulary(VOCABULARY)
    for white in (" ", "\n", " \n\t"):
        text = "begin" + white * (5_000_000 // len(white)) + "end"
        ids = encode(multi, text)
        assert multi.decode_bytes(ids) == text.encode()
        assert ids[:1] == encode(multi, "begin")[:1]
        assert plain.decode_bytes(encode_added(plain, text)) == text.encode()


def test_the_class_is_the_pattern_s_white_space():
    probe = tiktoken.Encoding("probe", pat_str=r"\s+|\S", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    white = re.compile(f"[{byte_bpe.WHITE}]")
    import regex
    for c in map(chr, [*range(0x3100), 0xfeff, 0x1f600]):
        assert bool(white.fullmatch(c)) == bool(regex.fullmatch(r"\p{White_Space}", c)), hex(ord(c))
    assert probe.decode(probe.encode_ordinary("a b")) == "a b"


# --- pages --------------------------------------------------------------

class Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out = []

    def handle_data(self, data):
        self.out.append(data)


def test_deep_nesting_and_unclosed_tags(spark):
    n = 100_000
    pages = [(1, "u", "<div>" * n + "<p>The text inside.</p>" + "</div>" * n), (2, "u", "<b>" * n + "<p>The text inside.</p>" + "</i></b>" * n),
             (3, "u", "<article>" + "<div class='post'><span>" * 2000 + "The text inside."), (4, "u", "<a " * n), (5, "u", "<p>The text inside.<" + "div " * n)]
    t0 = time.perf_counter()
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(df).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["The text inside."] * 3 and got[4] == ""
    records = derive_records(response_records(df)).collect()
    assert len(records) == 2 * len(pages)
    assert time.perf_counter() - t0 < 90


def test_blocks_of_random_pages_hold_their_visible_text():
    r = random.Random(3)
    tags = ["p", "div", "b", "a", "li", "ul", "td", "tr", "table", "h1", "em"]
    for _ in range(400):
        page = "".join(r.choice([f"<{r.choice(tags)}>", f"</{r.choice(tags)}>", f"w{r.randint(0, 99)} "]) for _ in range(60))
        other = Text()
        other.feed(page)
        assert " ".join(b.text for b in text_blocks(page)).split() == "".join(other.out).replace("w", " w").split() or \
            "".join(b.text for b in text_blocks(page)).replace(" ", "") == "".join(other.out).replace(" ", "")


OLD_HREF = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def test_links_and_titles_against_one_pattern():
    r = random.Random(4)
    bits = ["<a ", "<A\n", "<a>", "<abbr ", "href", " href=", "HREF = ", '"x>y"', "'q'", '"', "'", ">", " z ", "<title", "</title>", "T &amp; U", "<b href=1>", "\n"]
    from html import unescape
    for _ in range(4000):
        page = "".join(r.choices(bits, k=r.randint(1, 25)))
        assert outlinks(page) == [unescape(m[1] or m[2] or m[3] or "") for m in OLD_HREF.finditer(page)], page
        m = re.search(r"<title[^>]*>(.*?)(?:</title|\Z)", page, re.I | re.S)
        assert title(page) == (" ".join(unescape(m[1]).split()) if m else ""), page


@pytest.mark.parametrize("bit", ["<a ", "<a href ", "<title ", "<a href=\"", "<a>", "< a", "<a x='"])
def test_five_megabytes_of_tags_take_linear_time(bit):
    t0 = time.perf_counter()
    page = bit * (5_000_000 // len(bit))
    outlinks(page), title(page)
    assert time.perf_counter() - t0 < 20


# --- texts of any spacing ------------------------------------------------

@pytest.mark.parametrize("between", [" ", "\t", "　 ", "\r\n", "\x0b"])
@pytest.mark.parametrize("longest", [3, 90])
def test_long_texts_have_the_windows_of_the_whole(monkeypatch, between, longest):
    r = random.Random(longest)
    net = new_net(5)
    net.table[:] = np.random.default_rng(1).standard_normal(net.table.shape)
    for n in (1, 31, 32, 33, 55, 56, 57, 200, 1001):
        text = between.join("".join(r.choices("abcé.", k=r.randint(1, longest))) for _ in range(n))
        whole = score_texts(net, [text])[0]
        monkeypatch.setattr(toxicity, "TEXT_CHARS", 400)
        cut = stretches(text)
        assert len(cut) > 1 or len(text) <= 400 or n <= 57
        assert abs(worst_windows(net, [text])[0] - whole) < 1e-4 * max(1, abs(whole))
        monkeypatch.undo()


def test_two_million_characters():
    net = new_net(5)
    text = "\t".join(["word"] * 400_000)
    assert len(stretches(text)) > 3 and np.isfinite(worst_windows(net, [text, "x" * 2_000_000])).all()


# --- the sample -----------------------------------------------------------

def test_the_sample_takes_texts_that_fit_and_one_of_an_id(spark):
    rows = [(i, "x" * (50 if i % 2 else 5)) for i in range(40)] + [(2, "a"), (2, "b")] + [(100, None)]
    known = spark.createDataFrame([(i, int(i % 4 < 2)) for i in [*range(40), 100, 200]], "id bigint, label int")
    got = [tuple(r) for r in labelled_sample(docs(spark, rows), known, 6, 10, "doc_id", "text").collect()]
    assert len(got) == 12 and len({i for i, _, _ in got}) == 12
    assert all(len(t) <= 10 and i % 2 == 0 and y == int(i % 4 < 2) for i, t, y in got)
    assert {t for i, t, _ in got if i == 2} <= {"a"}
    seen = in_one_task(labelled_sample(docs(spark, rows), known, 6, 10, "doc_id", "text"), lambda some, labels: repr(sorted(zip(labels, some))).encode())
    assert seen == repr(sorted((y, t) for _, t, y in got)).encode()
    assert in_one_task(labelled_sample(docs(spark, []), known, 6, 10, "doc_id", "text"), lambda some, labels: b"none" if not some else b"some") == b"none"
