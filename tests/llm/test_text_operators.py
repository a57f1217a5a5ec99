import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tests.llm.conftest import same
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, html_render, lang_id, license_scan, quality_rules, secret_scan, url_filter

PATH = public_tokenizers.path("word_bpe_49k.json")


# Secret scans -------------------------------------------------------------------------------------------------------

def brute_spans(text):
    """Tries each start in turn."""
    patterns = [r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "AKIA[A-Z0-9]+",
                "[0-9a-f]+"]
    found = []
    for kind, pattern in enumerate(patterns):
        rule = re.compile(pattern, re.I | re.A if not kind else re.A)
        at = 0
        while at < len(text):
            m = rule.match(text, at)
            if m:
                n = len(m[2]) if kind == 0 else len(m[0])
                if n >= (6, 20, 24)[kind]:
                    found.append((at, kind, m.end()))
                at = m.end()
            else:
                at += 1
    return sorted(found)


SECRETS = ["", "password=abc", "PassWord = 'abcdef'", "api_key:aaaaaaa apikey=bbbbbb API-KEY=cccccccc", "\u017fecret=abcdefgh",
           "AKIA" + "X" * 15, "AKIA" + "X" * 16, "é AKIAAKIA" + "9" * 20, "f" * 23 + " " + "f" * 24, "token=" + "ab12" * 8,
           "secret: " + "0" * 30 + "; passwd:x", "password=\u00e9bcdefg token =\t abcdefg"]


@pytest.mark.parametrize("text", SECRETS)
def test_base_spans(text):
    assert secret_scan.base_spans(text) == brute_spans(text)


def test_secret_query(docs, no_docs, rows):
    found = secret_scan.secret_spans(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()
    expected = []
    for doc_id, text, *_ in rows:
        spans = brute_spans(text or "")
        counts = Counter(k for _, k, _ in spans)
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        expected.append((doc_id, counts[0], counts[1], counts[2], hashlib.sha256(listed.encode()).hexdigest()))
    same(found, expected)
    assert secret_scan.secret_spans(no_docs).collect() == []


def brute_bits(value):
    """All segmentations of a value without repeats, walks and dates."""
    ranks = {w: k for k, w in reversed([*enumerate(secret_scan.WORDS, 1)])}

    def least(a, brute):
        if a == len(value):
            return 0.0
        c = value[a]
        bits = (math.log2(10) if c.isdigit() else math.log2(26) if c.isalpha() else math.log2(33)) + c.isupper()
        options = [least(a + 1, True) + bits + (not brute)]
        options += [least(a + len(w), False) + math.log2(r + 1) + 1 for w, r in ranks.items() if value.startswith(w, a)]
        return min(options)
    return least(0, False)


@pytest.mark.parametrize("value", ["", "z", "password", "mytoken", "xkpasswordq", "kbgmz", "testuserv", "zb!vnk"])
def test_guess_cost_is_the_minimum(value):
    assert secret_scan.guess_bits(value) == pytest.approx(brute_bits(value))


def test_guess_cost_orders():
    cost = secret_scan.guess_bits
    for easy, hard in (("password123", "hX9$kq2!vLmz"), ("aaaaaaaaaaaaaaaa", "akfjwoeiqpmznxbv"), ("1987-12-24", "7193846502"),
                       ("qwertyuiop", "qpwoeirutm"), ("abcabcabcabc", "abcxqzabkwmv"), ("P4ssword", "Pxzkvmrq")):
        assert cost(easy) < cost(hard) and cost(easy) < 40
    assert cost("x" * 100_000) < 40
    for unit in ("ab", "1999", "banana", "xkqz12"):  # a repeat is walked through once, whatever its length
        assert cost(unit * 20_000) < 60
    spans = secret_scan.scan("pwd: 'hX9$kq2!vLmzPq' passphrase: changeme https://u:hX9$kq2!vLmzPq@h", secret_scan.GuessRules())
    assert spans[5] == 2 and spans[4] == "guess:6:20,guess:53:67"


@pytest.mark.parametrize("value", ["xK9$mQ2!", "v7#Lq@2Z", "T4&zR!9w", "k3x9q2m7", "aB3dE6gH", "zb!vnk#q", "K3X9Q2M7"])
def test_random_values_of_eight_characters(value):
    rules = secret_scan.GuessRules()
    assert secret_scan.guess_bits(value) >= rules.min_bits
    for text in (f"password: {value}", f"passphrase = '{value}'", f"postgres://app:{value.replace('@', '%')}@db/x"):
        found = secret_scan.redacted(text, rules, "#")
        assert value.replace("@", "%") not in found.replace("@", "%") and found != text
    for easy in ("Summer2024!", "P4ssword", "Password123!", "changeme", "your_password", "1987-12-24", "Qwerty123"):
        assert secret_scan.guess_bits(easy) < rules.min_bits


def test_contexts_of_any_length():
    rules, hard = secret_scan.GuessRules(), "hX9$kq2!vLmzPq"
    for text, name in ((f"passphrase{' ' * 30}={' ' * 30}{hard}", hard), (f"pwd\t\t{' ' * 9}:{' ' * 9}'{hard}'", hard),
                       (f"passphrase  is   {hard}", hard), (f"bearer{' ' * 20}{hard}", hard),
                       (f"https://{'u' * 300}:{hard}@h", hard), (f"https://u:{hard * 20}@h", hard * 20)):
        assert secret_scan.redacted(text, rules, "#") == text.replace(name, "#")
    for text in ("password" + " " * 1_000_000, "://u:" * 200_000, "://" + "u" * 1_000_000 + ":" + "p" * 1_000_000):
        assert secret_scan.guess_spans(text, [], rules)[0] == []


def test_redaction(spark, docs, rows):
    text = "é password=abcdef123456 then " + "ab" * 16 + " pwd: 'hX9$kq2!vLmzPq'."
    got = secret_scan.redacted(text, secret_scan.GuessRules(), "#")
    assert got == "é # then # pwd: '#'."
    out = secret_scan.redact_secrets(docs)
    assert out.schema == docs.schema and out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert "hunter" not in got[15].text and got[15].n_chars == len(got[15].text) and got[3].text is None


# BPE ----------------------------------------------------------------------------------------------------------------

def test_bpe_is_the_library(docs, no_docs, rows):
    library = Tokenizer.from_file(PATH)
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(plain.encode()).hexdigest(), ids))
    same(bpe.bpe_tokens(docs, PATH, with_ids=True).collect(), expected)
    assert bpe.bpe_tokens(no_docs, PATH).collect() == []


@pytest.mark.parametrize("text", ["<|endoftext|>a <|startoftext|><|endoftext|", "it's WE'LL 123 ½ Ⅷ x²", "e\u0301 \u1e9b\u0323 ﬁ Å",
                                  "𝕏 \U0001f600\U0001f3fd \u200d ก็ 汉字", "ΑΣ ΑΣΑ İI", "Ⱥx \u2028\u0085\x1f"])
def test_bpe_on_odd_characters(text):
    library, own = Tokenizer.from_file(PATH), bpe.encoder(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words():
    library, own = Tokenizer.from_file(PATH), bpe.Encoder(PATH)
    chars = [chr(0x4E00 + k * 7919 % 0x5000) for k in range(20_000)]
    for text in ("".join(chars), "".join(chars[:60]) + " " + "".join(chars), "ab" * 5_000, "q" * 70 + " q"):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert own.of_word.cache_info().currsize == 2  # the words of at most LONGEST_REMEMBERED characters


def test_every_character_below_the_settled_range():
    library, own = Tokenizer.from_file(PATH), bpe.encoder(PATH)
    for c in range(bpe.SETTLED):
        for text in (f"a{chr(c)}b {chr(c)}", f"{chr(c)}\u0301{chr(c)}"):
            assert library.encode(text, add_special_tokens=False).ids == own.encode(text), hex(c)


def test_forced_boundaries():
    own = bpe.encoder(PATH)
    words = [b"information", b"xqzvk", "straße".encode(), b"a" * 300, b"thethethe" * 30]
    for word in words:
        parts = own.fragments(word)
        assert b"".join(parts) == word
        joined = [i for k, p in enumerate(parts, 1) for i in own._fragment(p, k == len(parts))]
        whole = [own.first[b] for b in word]
        whole[-1] = own.last[word[-1]]
        assert tuple(joined) == own._by_heap(whole)


# HTML ---------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("a < b &amp; c", "a < b & c"), ("<p>x<p>y<div>z", "x\n\ny\n\nz"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ol start=9><li>x<li>y</ol></ul>t", "- a\n- b\n  9. x\n  10. y\n\nt"),
    ("<table><tr><th>Name<th>N<tr><td>long one<td>2<tr><td>x<td>30</table>", "Name      N\nlong one  2\nx         30"),
    ("<table><td>a<td rowspan=2>b<tr><td>c<td>d</table>", "a  b\nc     d"),
    ("<head><title>t</title></head><script>if (a<b) '</p>'</script><style>p</style>v", "v"),
    ("<p hidden>n<p style='display: none'>n<p>y", "y"),
    ("<div style='visibility:hidden'>n<b style='visibility:visible'>y</b></div>", "y"), ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("<details>n<summary>s</summary>n</details>", "s"), ("x<a href='", "x"), ("</div></x>y</p>z", "y\n\nz"),
    ("<blockquote>q<dl><dt>t<dd>d</dl></blockquote>", "  q\n\n  t\n    d"), ("a \n b<i> c</i> d", "a b c d"), ("<!-- n -->y<!-- n", "y")])
def test_rendering(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<p class=it's>Hello</p><p>World</p>", "Hello\n\nWorld"), ('<img alt="foo""><p>rest of page</p>', "rest of page"),
    ("<p it's>a</p><p title='x'>b</p>", "a\n\nb"), ('<p title="a>b" x=">">c', "c"), ("<p title=a\"hidden\">y", "y"),
    ('<a href="x>y</a><p>z', "y\n\nz"), ('<a b="> c="', 'c="'), ('<a b="> <i>x</i> " y', 'x " y'), ("<a b='x'hidden>n</a>y", "y"),
    ("x<a b=\"c' d", "x"), ("<a href=x/>y</a>", "y"), ("<a = b=>y", "y")])
def test_unbalanced_quotes(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<html><head><title>t</title><h1>Hi</h1><p>text", "Hi\n\ntext"), ("<head><title>t</title>bare", "bare"),
    ("<head><div>d</div><p>p</p></head><body>b", "d\n\np\n\nb"), ("<head><meta x><link y><title>t</title>\n<style>s</style><base>", ""),
    ("<head><template><p>n</p>n</template><script>n</script> <p>y", "y"), ("<head><noscript><p>n</noscript>&amp;", "&"),
    ("<head></br>x", "x"), ("<head><header>h</header>", "h")])
def test_head_without_end(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<pre>x = <b>1</b>;</pre>", "x = 1;"), ("<pre><span>def</span> <span>f</span>():\n  <i>return</i>\t<b>1</b>\n\n# e\n</pre>z",
                                             "def f():\n  return        1\n\n# e\n\nz"),
    ("<pre>a<br>b<br><br>  <i>c</i></pre>", "a\nb\n\n  c"), ("<pre>a\n<b>\nb</b>  c</pre>", "a\n\nb  c"),
    ("<ul><li><pre>a <b>b</b>\n c</pre></ul>", "- a b\n   c"), ("<table><td><pre>a<b>b</b>\nc</pre><td>d</table>", "ab  d\nc")])
def test_pre_with_inline_elements(html, text):
    assert html_render.render(html) == text


def test_columns_of_long_cells_are_aligned():
    long = "word " * 19 + "ends!"
    got = html_render.render(f"<table><tr><td>{long}<td>1<td>x<tr><td>b<td>22<td>y<tr><td colspan=2>{long}{long}<td>z</table>")
    first, second, third = got.split("\n")
    assert first.index("1") == second.index("22") == 102 and first.index("x") == second.index("y") == third.index("z") == 202
    # A very long cell among many short rows: its neighbours start where those of the other rows do.
    long = "w" * 100_000
    got = html_render.render("<table>" + f"<tr><td>{long}<td>1" + "<tr><td>b<td>2" * 5_000 + "</table>").split("\n")
    assert got[0] == long and len({len(x) for x in got[1:]}) == 1 and len(got) == 5_002
    assert got[1].split() == ["1"] and sum(map(len, got)) < 20 * 120_000


def test_quotes_cost_linear_time():
    for page in ('<a b="> b="' * 100_000, "<a b='x\"" * 100_000, "<a b='>" * 100_000, '<a "' * 100_000 + ">y"):
        html_render.parse(page)


def test_deep_pages_and_query(spark):
    deep = "<div>" * 20_000 + "x" + "<table><tr><td>" * 300 + "y"
    assert html_render.render(deep).split() == ["x", "y"]
    pages = spark.createDataFrame([(1, "<p>a", 3), (None, None, 4), (1, "<p>a", 3)], "page_id long, html string, n_chars int")
    same(html_render.visible_text(pages).collect(), [(1, "a", 1), (None, "", 0), (1, "a", 1)])
    assert html_render.visible_text(pages.limit(0)).collect() == []


# Quality ------------------------------------------------------------------------------------------------------------

def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def test_quality_query(docs, no_docs, rows):
    found = quality_rules.quality_verdicts(docs)
    same(found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect(),
         [(r[0], *brute_quality(r[1])) for r in rows])
    kept = {r.doc_id for r in found.where("kept").collect()}
    assert kept >= {1, 2, 8, 9, None, *range(100, 130)} and not kept & {3, 4, 5, 7, 11, 14}
    good = quality_rules.keep_good(docs)
    assert good.schema == docs.schema and good.count() == found.where("kept").count()
    assert quality_rules.quality_verdicts(no_docs).collect() == [] and quality_rules.keep_good(no_docs).collect() == []


def test_compression_bands():
    rules, packer = quality_rules.Rules(), zstandard.ZstdCompressor(level=3)
    import random
    rng = random.Random(3)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(12)) for _ in range(2000))
    assert not quality_rules.judge(noise, rules, packer)[6]
    cycle = " ".join(f"item{k % 97}" for k in range(5000))
    assert not quality_rules.judge(cycle, rules, packer)[6]
    for n, size in ((4096, 1), (4097, 1), (5119, 1), (5120, 2), (8192, 2)):
        whole, bad, _ = quality_rules.compression_verdict(bytes(rng.randrange(256) for _ in range(n)), rules, packer)
        assert whole > 0.9 and bad == (0.0 if n == 4096 else 1.0), size


def test_compression_alone_decides():
    """Texts that meet all base rules and whose whole ratio is in its band."""
    import base64
    import random
    rules, packer = quality_rules.Rules(), zstandard.ZstdCompressor(level=3)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(words[:600]) for _ in range(n))
    noise = lambda n: base64.b64encode(bytes(rng.randrange(256) for _ in range(n))).decode()
    block = "the same line stands here again " * 800
    cases = [(prose(9000), True), (prose(4000) + " " + noise(15_000), False), (prose(9000) + "\n" + noise(12_000) + "\n" + prose(9000), False),
             (prose(9000) + " " + noise(1500), True), (prose(12_000) + " " + block, False), (prose(400), True)]
    for text, expected in cases:
        judged = quality_rules.judge(text, rules, packer)
        assert not judged[5] and judged[6] is expected, (len(text), judged)


# Languages ----------------------------------------------------------------------------------------------------------

def test_letters_and_words():
    settings = lang_id.Settings()
    for text in ("½", "x²"[1:], "Ⅷ", "①", "١٢", "_", "\u0301", "...", "", " \n"):
        assert not len(lang_id.subwords(text, settings)), text
    plain = lambda t: "".join(map(chr, lang_id._plain(t)))
    assert plain("Ab, c9d½e") == " ab c d e "
    # combining marks stay inside Indic and Thai words; alone they are no word
    assert plain("हिन्दी ที่นี่") == " हिन्दी ที่นี่ " and plain("- \u0301 a\u0301\u0300! \u0301b") == " a\u0301\u0300 b "
    assert plain("  x²y ") == " x y " and plain("𝔘n 你好") == " 𝔘n 你好 "


def test_prediction_is_softmax_of_the_averaged_vectors():
    import math
    import random
    rng = random.Random(2)
    settings = lang_id.Settings(buckets=64, sizes=(1, 2, 3))
    langs = ("a", "b", "c")
    weights = np.array([[rng.uniform(-2, 2) for _ in langs] for _ in range(64)], np.float32)
    model = lang_id.Model(settings, langs, weights, np.array([0.1, -0.2, 0.3]), 0.7, 0.5)
    for text in ("ab, ç1d Ab", "Nur ein Satz", "x", "é" * 50, "ab " * 40_000, "z" * 150_000):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        bag = []
        for word in words:
            w = f" {word} "
            bag += [w[i:i + n] for n in settings.sizes for i in range(len(w) - n + 1) if w[i:i + n].strip()]
        if len(text) < 1000:  # the buckets are those of the n-grams, one by one
            assert len(lang_id.subwords(text, settings)) == len(bag)
        mean = weights[lang_id.subwords(text, settings)].astype(np.float64).mean(0) + model.bias
        powers = [math.exp(z / 0.7) for z in mean]
        label, score = model.predict(text)
        if len(words) > 1 or len(text) < 1000:
            assert label == langs[int(np.argmax(mean))] and math.isclose(score, max(powers) / sum(powers), rel_tol=1e-6)
    assert model.predict("½ ② …") == ("und", 0.0) == model.predict(None)
    text = "один два\tтри " * 30_000 + "w" * 200_000
    assert "".join(lang_id.pieces(text)) == text and max(map(len, lang_id.pieces(text))) <= lang_id.PIECE



def test_language_query(spark, docs, no_docs, rows):
    import zlib
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    from pyspark.sql import functions as F
    rule = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = lang_id.language_ids(docs, rule).collect()
    again = lang_id.language_ids(docs.repartition(5), rule).collect()
    same(found, again)
    same([r[:2] for r in found], [(r[0], held(r[0])) for r in rows])
    learned = {r[2] for r in rows if r[2] and r[0] is not None and not held(r[0]) and re.search(r"[^\W\d_]", r[1] or "")}
    for r in found:
        assert 0 <= r.score <= 1 and (r.lang_pred in learned or (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False))
    assert all(r.lang_pred == "und" for r in found if r.doc_id in (3, 4, 5))
    assert lang_id.language_ids(no_docs, rule).collect() == []
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.language_ids(none, rule).collect()} == {"und"}


def test_subwords_are_n_grams():
    import numpy as np
    got = lang_id.subwords("Ab, c9d", lang_id.Settings(sizes=(1, 2, 3)))
    parts = [" ab ", " c ", " d "]
    n_grams = sum(len({*range(len(w) - n + 1)}) - (2 if n == 1 else 0) for w in parts for n in (1, 2, 3))
    assert len(got) == n_grams and len(np.unique(got)) > 10


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    from ledgerloom.llm.common import table
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = lang_id.language_ids(docs, F.crc32(F.col("doc_id").cast("string")) % 4 == 2).where("held_out")
    right = found.join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.95


# Licences and URLs --------------------------------------------------------------------------------------------------

def test_licences(spark):
    mit = license_scan.LICENSES["MIT"]
    texts = [(1, "Copyright (c) 2020 Somebody\n\n" + mit), (2, mit.upper().replace("SUBLICENSE", "sublicence")),
             (3, "MIT License\n" + mit), (4, None), (5, "Released under the MIT  licence"), (None, mit.replace('"', "\u201c")),
             (7, "Copyright x\nCopyright y"), (1, "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 digest", "2 license_id")
    found = [(r.doc_id, r.license_id) for r in license_scan.license_matches(docs).collect()]
    same(found, [(1, "MIT"), (2, "MIT"), (3, "MIT"), (4, None), (5, "MIT-notice"), (None, "MIT"), (7, None), (1, None)])
    assert license_scan.license_matches(docs.limit(0)).collect() == []


def test_wrapped_and_titled_licences(spark):
    import hashlib
    import textwrap
    wrap = lambda x, n: "\n\n".join(textwrap.fill(p, n) for p in x.split("\n\n"))
    isc, mit = license_scan.LICENSES["ISC"], license_scan.LICENSES["MIT"]
    before = lambda x, words: x.replace(" " + words, "\n" + words)
    notice = "Copyright (c) 2020 Somebody\nCopyright 2021, X\n * Copyright The Y Authors. All rights reserved.\n\n"
    texts = [(1, notice + wrap(isc, 72), "ISC"), (2, notice + before(isc, "copyright notice"), "ISC"),
             (3, before(mit, "COPYRIGHT HOLDERS"), "MIT"), (4, before(mit, "copyright notice"), "MIT"),
             (5, "ISC License\n\n" + notice + wrap(isc, 72), "ISC"), (6, "The MIT License (MIT)\n\n" + notice + wrap(mit, 78), "MIT"),
             *((10 + n, wrap(mit, n), "MIT") for n in range(40, 80)), (8, mit.replace("above copyright notice", "above"), None)]
    docs = spark.createDataFrame([r[:2] for r in texts], "doc_id long, text string")
    same([(r.doc_id, r.license_id) for r in license_scan.license_matches(docs).collect()], [(i, k) for i, _, k in texts])
    # A digest among those of further texts; a table of one's own holds no others.
    one = spark.createDataFrame([(1, "x  Y")], "doc_id long, text string")
    digest = hashlib.sha256(b"x y").hexdigest()
    own = license_scan.known(spark, {"Z": "z"}, {digest: "XY"})
    assert license_scan.license_matches(one, own).first().license_id == "XY" and own.count() == 2


def test_common_licences(spark):
    from pathlib import Path
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "BSD": "BSD-3-Clause", "MPL-2.0": "MPL-2.0"}
    if not all((folder / n).is_file() for n in names):
        pytest.skip("no licence files")
    docs = spark.createDataFrame([(n, (folder / n).read_text()) for n in names], "doc_id string, text string")
    same([(r.doc_id, r.license_id) for r in license_scan.license_matches(docs).collect()], names.items())


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/casino", "", "", None, "block"),
    ("http://WWW.Example.COM/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/x", "a.example.com", "/en/x", "example.com/en/", "block"), ("x://com/", "com", "/", "com/", "allow"),
    ("http://notcom", "notcom", "", None, "allow"), ("http://a.com", "a.com", "", None, "allow"),
    ("http://x.net/es/p", "x.net", "/es/p", "net/es/", "block"), ("http://x.org/casino", "x.org", "/casino", None, "block"),
    ("http://x.org/casinos", "x.org", "/casinos", None, "allow"), ("http://x.org/free", "x.org", "/free", None, "allow"),
    ("http://x.org/free?free", "x.org", "/free", None, "allow"), ("http://x.org/free?Bet=1", "x.org", "/free", None, "block"),
    ("h://É.org#a://b/c", "É.org", "", None, "allow"), ("h://x.org/écasino", "x.org", "/écasino", None, "block")])
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, 0)], "page_id long, url string, host int")
    row = url_filter.url_verdicts(pages).first()
    assert tuple(row)[:5] == (1, host, path, rule, verdict)


def test_no_urls(spark):
    assert url_filter.url_verdicts(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_term_hits_by_brute_force():
    import random
    rng, vocabulary = random.Random(5), url_filter.automaton()
    for _ in range(500):
        url = "".join(rng.choice([*url_filter.SOFT[:8], *url_filter.STRICT[:3], "-", "/", "a", "9", "é", "."]) for _ in range(8))
        one = lambda terms: {t for t in terms if re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", url)}  # noqa: E731, B023
        assert url_filter.hits(url, vocabulary) == (one(url_filter.STRICT), one(url_filter.SOFT))
