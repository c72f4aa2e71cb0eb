"""Main text of a web page by the distribution of text over its lines.

A page is turned into lines first: comments, scripts, styles and the markup of parts that never hold the article are
dropped together with what they hold, every block element ends a line, and the edge of a container leaves an empty line
behind; edges in or of a dropped part leave none. Over these lines the lengths of ``WINDOW`` lines are summed. The text begins
where that sum surges above ``SURGE`` and ends where it dives to nothing. The article reaches from the first to the last such
stretch whose lines are long enough beside those of the stretch with most text, or that lies in the container which
holds all of these; stretches that are mostly links do not count. What a page names as its article (``article`` or ``main``) is
a hint: stretches end at its edges, and where the one with most text lies in there, the article goes from the first surge to the
last dive in there. A name around less text than stands elsewhere decides nothing.

A part whose name marks it as no article text is dropped, unless it holds most of the text of the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines whose lengths are summed.
WINDOW = 3
#: Characters in a window at which the text begins.
SURGE = 1

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the article.
DROPPED = frozenset(
    "head script style noscript template svg math iframe object canvas audio video nav footer aside form button select textarea menu dialog title".split()
)
#: Elements that stand by themselves: each begins and ends a line.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose edge also leaves an empty line.
CONTAINERS = frozenset("article aside body div footer form header main nav section".split())
#: Elements that close an open paragraph.
ENDS_PARAGRAPH = BLOCKS - {"br"}
#: Words in class, id or role that mark a part as no article text.
CHROME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|commentlist|complementary|contentinfo|cookies?|consent|disqus|"
    r"footer|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|pagination|popup|promo|promoted|related|replies|reply|"
    r"search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Names that tell what a part has or lacks, not what it is.
MODIFIER = re.compile(r"(?:^|(?<=[\s_-]))(?:no|not|has|have|with|without)[_-]\S*", re.IGNORECASE)
#: Whole names of parts that hold no article even with most of the text.
NEVER = frozenset(
    "ad ads advert adverts advertisement advertising comment comments commentlist disqus replies reply cookie cookies consent newsletter popup modal promo "
    "promoted related sponsor sponsored".split()
)
#: A stretch belongs to the article if its lines have on average at least this part of the length of those of the stretch with most text.
DENSE = 0.25
#: Only the white space that HTML folds, and what Python calls white space besides.
_FOLD = re.compile(r"\s+")


class _Lines(HTMLParser):
    """Collects lines as pieces of text, with the container and, for each, whether it lies in an article of the page.

    Parts named as no article text are numbered, 0 is the page itself; which of them are dropped shows only at the end.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[tuple[str, int, bool]], bool, int]] = []  # pieces, in an article, container
        self.held: list[tuple[str, int, bool]] = []  # text, part, in a link
        self.open: list[tuple[str, bool, int, int]] = []  # tag, whether it drops its content, part and container around it
        self.dropping = self.articles = self.part = 0
        self.container = 0
        self.outer, self.last = [0], [0]  # by container, numbered as they open: the one around it, and the last one opened in it
        self.link = False
        self.around, self.plain, self.never = [0], [0], [False]  # by part: the one around it, length of text outside links, name in NEVER

    def end_line(self) -> None:
        if self.held:
            self.lines.append((self.held, self.articles > 0, self.container))
            self.held = []
        self.link = False

    def gap(self, part: int) -> None:
        if not self.dropping:
            self.lines.append(([("", part, False)], self.articles > 0, self.container))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        if tag in VOID:
            return
        if tag in ENDS_PARAGRAPH and any(t == "p" for t, *_ in self.open[-8:]):
            self._close("p")
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        hidden = any(k in ("hidden",) or k == "aria-hidden" and v == "true" for k, v in attrs)
        inside = self.articles and tag in ("header", "h1", "h2", "h3", "h4", "h5", "h6")
        drops = tag in DROPPED or tag == "header" and not self.articles or hidden
        self.open.append((tag, drops, self.part, self.container))
        self.dropping += drops
        if named and not self.dropping and not inside and tag not in ("html", "body", "article", "main") and CHROME.search(MODIFIER.sub(" ", named)):
            self.around.append(self.part)
            self.plain.append(0)
            self.never.append(not NEVER.isdisjoint(named.lower().split()))
            self.part = len(self.around) - 1
        if tag in CONTAINERS:
            self.gap(self.part)
            if tag != "body":
                self.outer.append(self.container)
                self.container = len(self.last)
                self.last.append(self.container)
        self.articles += tag in ("article", "main")
        self.link = self.link or tag == "a" and any(k == "href" for k, _ in attrs)

    def leave(self, container: int) -> None:
        """Close the open containers inside one."""
        while self.container != container:
            self.last[self.container] = len(self.last) - 1
            self.container = self.outer[self.container]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections of unknown name, at which the parser gives up, are comments up to the next ``>``, or to the end of the page."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else len(self.rawdata)

    def _close(self, tag: str) -> None:
        """Close the innermost open element of that name, and those opened in it; block edges stop the search for inline ones."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                for name, drops, _, _ in self.open[at:]:
                    self.dropping -= drops
                    self.articles -= name in ("article", "main")
                self.part, container = self.open[at][2:]
                self.leave(container)
                del self.open[at:]
                return
            if tag not in CONTAINERS and tag not in DROPPED and self.open[at][0] in CONTAINERS:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        if tag in CONTAINERS:
            self.gap(self.part)
        if tag == "a":
            self.link = False
        if tag not in VOID:
            self._close(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if not self.dropping:
            self.held.append((data, self.part, self.link))
            if not self.link:
                self.plain[self.part] += sum(map(len, data.split()))

    def shown(self) -> list[bool]:
        """By part, whether its text stays: parts with most of the text do, and what they lie in has to."""
        plain = self.plain[:]
        for part in range(len(plain) - 1, 0, -1):
            plain[self.around[part]] += plain[part]
        stays = [True]
        for part in range(1, len(plain)):
            stays.append(stays[self.around[part]] and 2 * plain[part] > plain[0] and not self.never[part])
        return stays


@dataclass
class Lines:
    """Lines of a page in order, empty ones included, and what is known of them."""

    texts: list[str]
    linked: np.ndarray  #: length of text in links
    containers: list[int]  #: innermost container of the line, 0 for the page
    outer: list[int]  #: by container, the one around it
    last: list[int]  #: by container, the last one opened in it
    inside: np.ndarray  #: whether the line lies in an article the page names itself


def lines_of(page: str) -> Lines:
    parser = _Lines()
    parser.feed(page)
    parser.close()
    parser.end_line()
    parser.leave(0)
    parser.last[0] = len(parser.last) - 1
    shown = parser.shown()
    texts, linked, inside, containers = [], [], [], []
    for pieces, in_article, container in parser.lines:
        left = [(data, link) for data, part, link in pieces if shown[part]]
        text = _FOLD.sub(" ", "".join([data for data, _ in left])).strip()
        if text or len(left) == 1 and not left[0][0]:
            texts.append(text)
            linked.append(sum(len(data.strip()) for data, link in left if link))
            inside.append(in_article)
            containers.append(container)
    return Lines(texts, np.array(linked, np.int64), containers, parser.outer, parser.last, np.array(inside, bool))


def text_stretches(lengths: np.ndarray, window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """Stretches of lines from a surge of the windowed length to its dive to nothing."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    ahead = total[np.minimum(np.arange(len(lengths)) + window, len(lengths))] - total[:-1]
    surges, dives = np.flatnonzero((lengths > 0) & (ahead >= surge)), np.append(np.flatnonzero(ahead == 0), len(lengths))
    stretches, at = [], 0
    for begin in surges.tolist():
        if begin >= at:
            at = int(dives[np.searchsorted(dives, begin)])
            stretches.append((begin, at))
    return stretches


def _article(lines: Lines) -> list[str]:
    """The lines of the article. Stretches end at the edges of what the page names as one."""
    lengths = np.fromiter(map(len, lines.texts), np.int64, len(lines.texts))
    stretches = sorted(s for part in (lines.inside, ~lines.inside) for s in text_stretches(np.where(part, lengths, 0)))
    if not stretches:
        return []
    all_of = [int(lengths[a:b].sum()) for a, b in stretches]
    plain = [n - int(lines.linked[a:b].sum()) for n, (a, b) in zip(all_of, stretches, strict=True)]
    most = max(range(len(stretches)), key=lambda k: (plain[k], all_of[k]))
    within = lines.inside[[a for a, _ in stretches]]
    if within[most]:
        named = np.flatnonzero(within)
        begin, end = stretches[named[0]][0], stretches[named[-1]][1]
        return [text for text, inside in zip(lines.texts[begin:end], lines.inside[begin:end].tolist(), strict=True) if inside]
    average = [n / np.count_nonzero(lengths[a:b]) for n, (a, b) in zip(all_of, stretches, strict=True)]
    prose = [k for k in range(len(stretches)) if k == most or 2 * plain[k] > all_of[k]]
    kept = [k for k in prose if average[k] >= DENSE * average[most]]
    held = [lines.containers[i] for k in kept for i in range(*stretches[k]) if lengths[i]]
    shared, highest = min(held), max(held)  # containers are numbered as they open: one holds all up to the last opened in it
    while lines.last[shared] < highest:
        shared = lines.outer[shared]
    kept += [k for k in prose if shared and shared <= lines.containers[stretches[k][0]] <= lines.last[shared]]
    return lines.texts[stretches[min(kept)][0] : stretches[max(kept)][1]]


def main_text(page: str | None) -> str:
    """The article: its blocks in page order, joined by one newline; empty without any."""
    return "\n".join(filter(None, _article(lines_of(page)))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row, from the whole html.

    A null or empty html, and one without an article, gives an empty text. Null ids and urls stay, repeated rows stay
    repeated, an empty table gives an empty one. Only these three columns are read, others may have any name.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [main_text(h) if isinstance(h, str) else "" for h in frame.pop("html")]
            yield frame.assign(text=text, n_chars=[len(t) for t in text])

    columns = [F.col(c).cast(t).alias(c) for c, t in (("page_id", "long"), ("url", "string"), ("html", "string"))]
    return pages.select(*columns).mapInPandas(run, "page_id long, url string, text string, n_chars long")
