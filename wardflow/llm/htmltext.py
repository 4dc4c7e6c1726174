"""Main text of web pages as the maximum-scoring stretch of words and tags.

A page is one sequence of text pieces and tags.  Every word scores +1, or less
than 0 where it stands in an element that labelled pages show as boilerplate; every
tag has a negative score, the more so the rarer it is inside the main text of
labelled pages.  One linear scan finds the contiguous stretch with the largest
sum; the words of boilerplate elements within it (a form, an advert) are left out.  The same
scan finds the other maximal stretches; those that stand directly in the same element belong to the main text too.
The time is linear in the page's length, however deep its elements nest.

Labelled pages are those with one ``article`` element, which marks its own main text;
the counts are added to a fixed prior over element names and class words, so that a
table without labelled pages, or with few kinds of elements, is served too.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator
from math import inf, log

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import read_table

SAMPLE_PAGES = 400  # labelled pages that are fitted, at most
SAMPLE_CHARS = 100_000  # longer ones are not taken for fitting; extraction reads whole pages
PRIOR = 50.0
MOST, LEAST = -8.0, -0.05  # range of a tag's score
PLAIN = -0.5  # least score of a tag that opens no section, outside boilerplate
BOILER_WORD = -0.5
RESCUE = 2.0  # what class words of content weigh at most against boilerplate further out
EVIDENCE_PAGES = 5  # labelled pages that show a class word outside main text before it counts as boilerplate
WRAPPER = 0.8  # share of a page's words in an element that wraps the page, where no article or main element tells
BESIDE = 10  # words of paragraphs that make a main part of their own, or another stretch of the main part
WITHIN = 0.02  # share of these that counts inside an article: its parts belong together, whatever stands between

# fixed values: element names and class words, by what they usually hold
BOILER = frozenset("""nav header footer aside form menu dialog button select textarea noscript template head title iframe
object svg canvas ad ads advert adverts advertisement banner promo promotion sponsor sponsored sidebar side navigation navbar
breadcrumb breadcrumbs masthead comment comments reply replies respond discussion disqus notice notices cookie
cookies consent gdpr popup modal overlay newsletter subscribe signup login search share sharing social related
recommended recommendations widget widgets pagination pager toolbar skip copyright legal alert complementary
contentinfo""".split())
READERS = frozenset("comment comments reply replies respond discussion disqus".split())
CONTENT = frozenset("article main content post entry story articlebody".split())
SECTIONS = frozenset("""nav header footer aside form menu dialog button select textarea noscript template head title
iframe object svg canvas article main""".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup
option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
PARAGRAPHS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    r"""<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"""
    r"""</?([A-Za-z][^\s/>]*)(?:(?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))|[^<]+|<""", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

_HAVING = re.compile(r"(?<!\S)(?:has|with|no|without)[-_]\S*")


def _features(name: str, tag: str) -> tuple[str, ...]:
    """What an element tells of its words: its name if it is a section, its class, id and role words.

    What it is said to have (``has-sidebar``, ``with-comments``) tells nothing of its own words.
    """
    words = {name} if name in SECTIONS else set()
    for groups in _NAMED.findall(tag):
        named = _HAVING.sub(" ", "".join(groups).lower())
        words.update(w for w in re.split(r"[^a-z0-9]+", named) if w and not w.isdigit())
    return tuple(sorted(words))


class _Page:
    """Pieces of a page, and the places where they stand.

    A piece is (kind, value, place): kind ``text`` with decoded text, or ``open``/``close``/``skip`` with a tag name.
    A place is the innermost open element that tells something of its words, and the place around it (none: -1, the
    page itself); an outer place comes before those inside it.
    """

    def __init__(self, page: str):
        self.pieces: list[tuple[str, str, int]] = []
        self.elements: list[tuple[str, tuple[str, ...]]] = []  # name, features
        self.places: list[tuple[int, int]] = []  # element, place around it
        self._open: Counter = Counter()  # names of the open elements
        self._sections = 0  # open sections other than article and main
        at = -1
        for m in _TOKEN.finditer(page):
            raw = m.group()
            if m.group(1):
                self.pieces.append(("skip", m.group(1).lower(), at))
            elif m.group(2):
                name = m.group(2).lower()
                if raw[1] == "/":
                    at = self._close(at, name)
                    self.pieces.append(("close", name, at))
                else:
                    at = self._start(at, name, raw)
            elif raw[0] != "<" or raw == "<":
                self.pieces.append(("text", htmllib.unescape(raw), at))
            else:
                self.pieces.append(("skip", "!", at))
        self._wrappers()

    def _start(self, at: int, name: str, raw: str) -> int:
        if name in ("article", "main") and self._sections:
            at = self._leave_sections(at)
        self.pieces.append(("open", name, at))
        if name in VOID or raw.endswith("/>") or not (name in BLOCKS or name in SECTIONS):
            return at
        if name == "body":
            at, self._sections = -1, 0
            self._open.clear()
        # class words of html, body and main describe the page
        own = _features(name, raw if name not in ("html", "body", "main") else "")
        if name in SECTIONS or own or name == "div":
            self.elements.append((name, own))
            self.places.append((len(self.elements) - 1, at))
            at = len(self.places) - 1
            self._open[name] += 1
            self._sections += _leaves(name)
        return at

    def _close(self, at: int, name: str) -> int:
        """The place around the innermost open element of that name; ``at`` if none is open."""
        while self._open[name]:
            element, at = self.places[at]
            closed = self.elements[element][0]
            self._open[closed] -= 1
            self._sections -= _leaves(closed)
            if closed == name:
                break
        return at

    def _leave_sections(self, at: int) -> int:
        """The place without open sections other than ``article`` and ``main``; an article inside them means they were left open."""
        inner: list[int] = []  # elements inside the outermost such section, which stand at new places
        while self._sections:
            element, at = self.places[at]
            name = self.elements[element][0]
            if _leaves(name):
                self._sections -= 1
                self._open[name] -= 1
            else:
                inner.append(element)
        for element in reversed(inner):
            self.places.append((element, at))
            at = len(self.places) - 1
        return at

    def _wrappers(self) -> None:
        """``features`` of the elements: class words of what wraps the page's main part say nothing about that part.

        They are left out for the page's largest article, and for all elements around this and around the largest
        ``main``; on a page with neither, for plain elements that hold nearly all words.  Of the latter, known words of
        boilerplate stay where paragraphs outside, not themselves in boilerplate, may be the main part; those of
        reader comments stay beside any such paragraph.
        """
        elements, places = self.elements, self.places
        self.features = [own for _, own in elements]
        below = [0] * (len(places) + 1)  # words; the last: on the page itself
        paragraphs = [0] * (len(places) + 1)  # words in paragraphs and headings, outside known boilerplate
        known = [False] * (len(places) + 1)
        for at, (element, around) in enumerate(places):
            known[at] = known[around] or any(f in BOILER for f in elements[element][1])
        heading = False
        for kind, value, at in self.pieces:
            if kind == "text":
                n = len(value.split())
                below[at] += n
                paragraphs[at] += n if heading and not known[at] else 0
            elif kind != "skip" and value in BLOCKS:
                heading = kind == "open" and value in PARAGRAPHS
        held = [0] * len(elements)
        own = [0] * len(elements)
        for at in range(len(places) - 1, -1, -1):
            element, around = places[at]
            held[element] += below[at]
            own[element] += paragraphs[at]
            below[around] += below[at]
            paragraphs[around] += paragraphs[at]
        largest = [max(found, key=lambda i: (held[i], -i)) for name in ("article", "main")
                   if (found := [i for i, e in enumerate(elements) if e[0] == name])]
        for i in largest:
            self.features[i] = (elements[i][0],)
            at = next(p for p, (element, _) in enumerate(places) if element == i)
            while (at := places[at][1]) >= 0:
                j = places[at][0]
                self.features[j] = tuple(f for f in self.features[j] if f == elements[j][0])
        if not largest:
            for i, (name, fs) in enumerate(elements):
                if name not in SECTIONS and held[i] >= WRAPPER * below[-1]:
                    beside = paragraphs[-1] - own[i]
                    stay = BOILER if beside >= BESIDE else READERS if beside else frozenset()
                    self.features[i] = tuple(f for f in fs if f in stay)

    def amid(self) -> list[bool]:
        """For each place, and last the page itself, whether it is in an article or ``main``."""
        out = [False] * (len(self.places) + 1)
        for at, (element, around) in enumerate(self.places):
            out[at] = out[around] or "article" in self.features[element] or "main" in self.features[element]
        return out


def _leaves(name: str) -> bool:
    return name in SECTIONS and name not in ("article", "main")


class Weights:
    """Log-odds of element features for words, and scores of tags."""

    def __init__(self, words: dict[str, float], tags: dict[str, float]):
        self.words, self.tags = words, tags

    def boiler(self, page: _Page) -> list[bool]:
        """For each place, and last the page itself, whether it is boilerplate.

        It is where the log-odds of the open elements, summed from the innermost and never above ``RESCUE``, fall
        under -1 at any of them.  ``need`` is the least sum with which one may come from inside to a place
        and stay clear of that, so a place takes it from the one around it.
        """
        need = [-inf] * (len(page.places) + 1)
        for at, (element, around) in enumerate(page.places):
            need[at] = need[around]
            if fs := page.features[element]:
                least = max(-1.0, need[around])
                odds = sum(self.words.get(f, 0.0) for f in fs if f not in ("article", "main"))
                need[at] = least - odds if least <= RESCUE else inf
        return [n > 0.0 for n in need]

    def tag(self, kind: str, name: str, amid: bool, boiler: bool) -> float:
        """Score of a tag; amid main text one that opens no section, where its like may be a mere link, costs little."""
        if amid:
            return WITHIN * max(PLAIN, self.tags.get(f"{kind} {name}", LEAST * 4))
        if name in SECTIONS or boiler:
            return self.tags.get(f"{kind} {name}", -1.0)
        return max(PLAIN, self.tags.get(f"{kind} {name}", LEAST * 4))

    def word(self, amid: bool, boiler: bool) -> float:
        if not boiler:
            return 1.0
        return BOILER_WORD * (WITHIN if amid else 1.0)


def fit(labelled: list[str]) -> Weights:
    """Weights from pages whose ``article`` element marks the main text."""
    inside: Counter = Counter({f: PRIOR for f in CONTENT})
    outside: Counter = Counter({f: PRIOR for f in BOILER})
    tag_in: Counter = Counter()
    tag_out: Counter = Counter()
    prior = Weights({f: log((inside[f] + 1) / (outside[f] + 1)) for f in CONTENT | BOILER}, {})
    shown: Counter = Counter()  # pages with a feature outside their main text
    for text in labelled:
        page = _Page(text)
        boiler = prior.boiler(page)
        article = [False] * (len(page.places) + 1)
        for at, (element, around) in enumerate(page.places):
            article[at] = article[around] or "article" in page.features[element]
        words_in, words_out = [0] * (len(page.places) + 1), [0] * (len(page.places) + 1)
        for kind, value, at in page.pieces:
            main = article[at] and not boiler[at]
            if kind == "text":
                (words_in if main else words_out)[at] += len(value.split())
            else:
                border = value in ("article", "main")
                (tag_in if main and not border else tag_out)[f"{kind} {value}"] += 1
        for at in range(len(page.places) - 1, -1, -1):
            around = page.places[at][1]
            words_in[around] += words_in[at]
            words_out[around] += words_out[at]
        apart: set[str] = set()
        for at, f in _outermost(page):  # a word of the page counts once for each feature around it
            inside[f] += words_in[at]
            outside[f] += words_out[at]
            if words_out[at]:
                apart.add(f)
        shown.update(apart)
    n_in, n_out = sum(tag_in.values()) + 1, sum(tag_out.values()) + 1
    words = {}
    for f in inside | outside:
        least = 1 if f in CONTENT or f in BOILER else PRIOR  # words without a prior: as many again to speak for either side
        odds = log((inside[f] + least) / (outside[f] + least))
        words[f] = odds if f in BOILER or shown[f] >= EVIDENCE_PAGES else max(0.0, odds)
    tags = {t: max(MOST, min(LEAST, log((tag_in[t] + 0.5) / n_in) - log((tag_out[t] + 0.5) / n_out)))
            for t in tag_in | tag_out}
    for name in BLOCKS - SECTIONS:  # tags of text blocks that the labelled pages lack
        for kind in ("open", "close"):
            tags.setdefault(f"{kind} {name}", LEAST * 4)
    return Weights(words, tags)


def _outermost(page: _Page) -> Iterator[tuple[int, str]]:
    """Places with those of their features that no place around them has."""
    inner: dict[int, list[int]] = {}
    for at, (_, around) in enumerate(page.places):
        inner.setdefault(around, []).append(at)
    around_here: Counter = Counter()
    todo = [(at, True) for at in inner.get(-1, [])]
    while todo:
        at, enter = todo.pop()
        features = page.features[page.places[at][0]]
        if not enter:
            around_here.subtract(features)
            continue
        yield from ((at, f) for f in features if not around_here[f])
        around_here.update(features)
        todo.append((at, False))
        todo += [(i, True) for i in inner.get(at, [])]


def stretches(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal-scoring stretches (score, first, behind the last), in order; one linear scan.

    None can be made longer or shorter without a loss, and they do not overlap; the largest is the
    maximum-scoring stretch of all.
    """
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum behind, first, behind, the last one that starts lower
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0.0:
            continue
        low, first = before, i
        last = len(found) - 1
        while True:
            while last >= 0 and found[last][0] >= low:
                last = found[last][4]
            if last < 0 or found[last][1] >= total:
                break
            low, first = found[last][0], found[last][2]  # that one, all behind it and this piece are one stretch
            del found[last:]
            last = len(found) - 1
        found.append((low, total, first, i + 1, last))
    return [(high - low, first, behind) for low, high, first, behind, _ in found]


def extract(html: str | None, weights: Weights) -> str:
    """Main text of one page; null, empty and wordless pages: empty.

    The maximum-scoring stretch, and the other stretches of a paragraph's length directly in the same element: what
    parts them (a long list of links) is left out, what follows it is not.
    """
    page = _Page(html or "")
    boiler, amid = weights.boiler(page), page.amid()
    scores = [len(value.split()) * weights.word(amid[at], boiler[at]) if kind == "text"
              else weights.tag(kind, value, amid[at], boiler[at]) for kind, value, at in page.pieces]
    found = stretches(scores)
    if not found:
        return ""
    depth = [0] * (len(page.places) + 1)
    holder = list(range(len(page.places))) + [-1]  # the place itself, or around it if it is a mere paragraph
    for at, (element, around) in enumerate(page.places):
        depth[at] = depth[around] + 1
        if page.elements[element][0] in PARAGRAPHS:
            holder[at] = holder[around]

    def parent(first: int, behind: int) -> int:
        return holder[min((at for _, _, at in page.pieces[first:behind]), key=lambda at: depth[at])]
    top = max(found, key=lambda s: s[0])
    home = parent(*top[1:])
    blocks: list[list[str]] = [[]]
    for score, first, behind in found:
        if first != top[1] and (score < BESIDE or parent(first, behind) != home):
            continue
        blocks.append([])
        for kind, value, at in page.pieces[first:behind]:
            if kind == "text":
                if not boiler[at]:
                    blocks[-1].append(value)
            elif value in BLOCKS:
                blocks.append([])
            elif value == "br":
                blocks[-1].append(" ")
    return " ".join(t for b in blocks if (t := " ".join("".join(b).split())))


def train(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> Weights:
    """Weights from at most ``sample`` pages that label themselves."""
    own = pages.select(F.col(html_col).alias("html")).where(
        F.col("html").contains("<article") & (F.length("html") <= SAMPLE_CHARS))
    own = own.withColumn("digest", F.sha2("html", 256))
    picked = own.select("digest").distinct().orderBy("digest").limit(sample)  # digests only; at most ``sample``
    rows = own.join(F.broadcast(picked), "digest", "left_semi").dropDuplicates(["digest"]).orderBy("digest").collect()
    return fit([r["html"] for r in rows])


def main_text(pages: DataFrame, weights: Weights, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All input columns and ``out_col``, the main text (a column of that name is replaced).

    The whole page is read.  Null and empty pages give an empty text; repeated
    rows stay; character references are decoded, also without semicolon, as browsers do.
    """
    @F.pandas_udf("string")
    def content(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([extract(h, weights) for h in htmls], dtype=object)
    return pages.withColumn(out_col, content(F.col(html_col)))


def op5_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = main_text(pages, train(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op5_htmltext": op5_htmltext}
ORACLES: dict[str, str] = {}  # learned weights: tests compare with hand-marked pages
