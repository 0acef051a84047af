"""The main text of web pages.

A page is read into blocks of text. Elements that never hold main text (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments of readers) are told by their name, role, class or id, and
whatever stands in them is marked; unless that is the page's only article or most of its text. What stands inside
an article or main element is its text.

Marks and repetition decide together, on every page: runs of at least ``MIN_RUN`` tokens that occur on distinct pages
of a host are looked for by the suffixes of its texts, dealt and ordered by a 128-bit hash of host and first
``MIN_RUN`` tokens, so that equal runs always meet and a host of any size is spread over all tasks. Suffixes that begin
alike at neighbouring places make up one longer run. Pages that are copies of each other count as one page, so a
copied article does not cover itself.

* Where a page marks no article, such runs are boilerplate, and of each unmarked block the tokens not covered stay.
* In an article, a block is boilerplate if it is covered from end to end by runs that half of the pages of the host,
  and ``LEAST_PAGES`` at least, hold in marked elements or beside their article: a notice that is marked elsewhere. What
  fewer hold, or other articles repeat, stays, as it is the article's text, and so does everything where such blocks are
  half of the article or more.

The first suffix of each block of an article is looked up first; the others of a block only where that one is found.
``repeated`` and ``main_texts`` do the same for pages held in memory, by a suffix array.

Character references are decoded, white space within a block becomes one space, blocks are joined by an empty
line. Null and empty pages have an empty text. Pages without a host are one host of their own. Repeated rows
and null ids are extracted like any other; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.cluster import broadcast_if_small
from matchboard.llm.common import stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS = re.compile(r"[a-z0-9]+")

RAW = frozenset("script style noscript template textarea iframe svg math object".split())
SKIPPED = RAW | frozenset("head title nav aside footer form button select dialog menu fieldset label option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
BLOCKS = HEADINGS | frozenset(
    "p div section article main header ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption "
    "address hr body html center details summary nav aside footer form fieldset".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDED_BY_BLOCK = frozenset(["p"])
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}

# Words in a class, id or role that mark an element as not being main text.
MARKS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts advertisement "
    "advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social comment comments disqus reply replies related recommended recommendations "
    "widget toolbar pagination pager copyright search form contentinfo complementary dialog".split()
)
MIN_RUN = 8  # tokens
LEAST_PAGES = 3  # that hold a notice
FEW_PAGES = 20_000  # what is found in them is broadcast
BETWEEN = "\n\n"  # blocks; none holds a line break
RUNS_AT_ONCE = 1 << 16  # rows of runs that leave a task at a time


# Such elements are never taken for the page's own text, whatever stands in them.
OF_READERS = frozenset("comment comments disqus reply replies related recommended recommendations newsletter".split())
# "no-sidebar" and "with-sidebar" say something about the rest of the page.
ABOUT_OTHERS = frozenset("no not non without with has have is show hide free".split())


def _marked(attributes: str) -> str | None:
    """The word in a class, id or role by which an element is not main text; None for others.

    A name counts as a whole, or by its last part ("site-footer"), as the parts before only tell which one it is.
    """
    found = None
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return "hidden"
        if name in ("class", "id", "role"):
            for whole in value.split():
                words = WORDS.findall(whole)
                if words and words[-1] in MARKS and ABOUT_OTHERS.isdisjoint(words[:-1]):
                    found = words[-1] if found not in OF_READERS else found
    return found


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in an article, marked as not being main text) of each block in page order.

    Marks are names given by the page's author, so the page may speak against them: an element that holds the page's
    only article or main element, or more than half of its text, is no menu or sidebar, whatever its class says.
    """
    found, held = _blocks(page, frozenset())
    wrong = set()
    if held and not any(inside and not skipped for _, inside, skipped in found):
        articles = {n for n, (word, article, _) in held.items() if article and word not in OF_READERS and word != "hidden"}
        if articles:
            wrong = articles
        elif (size := sum(n for _, _, n in held.values()) + sum(len(t) for t, _, skipped in found if not skipped)):
            wrong = {n for n, (word, _, own) in held.items() if 2 * own > size and word not in OF_READERS and word != "hidden"}
    return _blocks(page, frozenset(wrong))[0] if wrong else found


def _blocks(page: str | None, unmarked: frozenset[int]) -> tuple[list[tuple[str, bool, bool]], dict[int, tuple[str, bool, int]]]:
    """The blocks, and for each element that is out by its mark alone: the word, whether an article or main element
    stands in it, and how long its text is. Elements in ``unmarked``, told by their number, keep their text."""
    page = page or ""
    held: dict[int, list] = {}
    n_marked, owner = 0, -1  # the outermost marked element that is open, if nothing else hides it
    found: list[tuple[str, bool, bool]] = []
    open_tags: list[tuple[str, bool, bool, int, bool]] = []  # name, in an article, skipped, owner, a header of an article
    text: list[str] = []
    inside = skipped = False

    def flush():
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined:
                found.append((joined, inside, skipped))
                if owner >= 0:
                    held[owner][2] += len(joined)

    def close(depth: int):
        nonlocal inside, skipped, owner
        del open_tags[depth:]
        inside, skipped, owner = open_tags[-1][1:4] if open_tags else (False, False, -1)

    at, n = 0, len(page)
    while at < n:
        hit = TOKEN.search(page, at)
        if hit is None:
            text.append(page[at:])
            break
        text.append(page[at : hit.start()])
        at = hit.end()
        name = hit[2].lower() if hit[2] else ""
        if not name:
            continue
        if not hit[1] and name in RAW or not hit[1] and name == "title":
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        if name not in BLOCKS and name not in SKIPPED and not hit[3]:
            continue  # inline mark-up
        if hit[1]:
            depth = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), None)
            if name in BLOCKS or name in SKIPPED:
                flush()
            if depth is not None:
                if name not in BLOCKS and name not in SKIPPED and open_tags[depth][2]:
                    flush()
                close(depth)
            continue
        block = name in BLOCKS or name in SKIPPED
        word = _marked(hit[3]) if hit[3] and name not in ("html", "body", "article", "main") else None
        if not block and not word:
            continue
        flush()
        if name == "hr":
            continue
        if name in BLOCKS and open_tags and open_tags[-1][0] in ENDED_BY_BLOCK:
            close(len(open_tags) - 1)
        for kind in OWN_KIND.get(name, ()):
            if open_tags and open_tags[-1][0] == kind:
                close(len(open_tags) - 1)
                break
        # the headings of an article may stand in a header of it
        title = inside and not skipped and (name == "header" or word == "header")
        now_skipped, now_owner = skipped and not (open_tags and open_tags[-1][4] and name in HEADINGS), owner
        if owner >= 0 and name in ("article", "main"):
            held[owner][1] = True
        if name in SKIPPED or name == "header":
            now_skipped, now_owner = True, -1 if not skipped else owner
        elif word:
            n_marked += 1
            if not skipped and n_marked not in unmarked:
                now_owner = n_marked
                held[n_marked] = [word, False, 0]
            now_skipped = skipped or n_marked not in unmarked
        # an article that stands in another, or in marked elements, is a reader's comment or a teaser of those
        now_inside = inside or name in ("article", "main") and not skipped
        open_tags.append((name, now_inside, now_skipped, now_owner, title))
        inside, skipped, owner = now_inside, now_skipped, now_owner
        if hit[3].rstrip().endswith("/") and name not in BLOCKS:
            close(len(open_tags) - 1)
    flush()
    return found, {n: tuple(v) for n, v in held.items()}


def repeated(streams: list[list[str]], families: list[int], least: int = MIN_RUN) -> list[np.ndarray]:
    """For each token stream, which tokens lie in a run of ``least`` tokens that another family of pages has too."""
    numbers: dict[str, int] = {}
    n_pages = len(streams)
    flat = np.fromiter((numbers.setdefault(t, len(numbers) + n_pages) for s in streams for t in s), dtype=np.int64)
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    out = [np.zeros(n, dtype=bool) for n in sizes]
    if not len(flat):
        return out
    # the streams one after the other, each ended by a number of its own, so no run goes from page to page
    bounds = np.cumsum(sizes + 1)
    joined = np.empty(int(bounds[-1]), dtype=np.int64)
    stops = bounds - 1
    joined[stops] = np.arange(n_pages)
    inner = np.ones(len(joined), dtype=bool)
    inner[stops] = False
    joined[inner] = flat
    page_of = np.repeat(np.arange(n_pages), sizes + 1)
    # suffix array by doubling; ranks of the first `least` tokens are all that is asked for
    rank = np.unique(joined, return_inverse=True)[1].reshape(-1)
    width = 1
    while width < least:
        step = min(width, least - width)
        second = np.zeros(len(rank), dtype=np.int64)
        second[: max(0, len(rank) - step)] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + second, return_inverse=True)[1].reshape(-1)
        width += step
    order = np.argsort(rank, kind="stable")
    family = np.asarray(families)[page_of]
    heads = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
    group = np.cumsum(heads) - 1
    first = np.minimum.reduceat(family[order], np.nonzero(heads)[0])
    last = np.maximum.reduceat(family[order], np.nonzero(heads)[0])
    shared = np.zeros(len(rank), dtype=bool)
    shared[order] = (first != last)[group]
    begins = np.zeros(len(rank) + 1, dtype=np.int64)
    at = np.nonzero(shared)[0]
    np.add.at(begins, at, 1)
    np.add.at(begins, np.minimum(at + least, len(rank)), -1)
    covered = np.cumsum(begins[:-1]) > 0
    for i, (stop, n) in enumerate(zip(stops.tolist(), sizes.tolist())):
        out[i] = covered[stop - n : stop]
    return out


def _tokens(page: list[tuple[str, bool, bool]]) -> list[str]:
    return [t for text, _, _ in page for t in text.split(" ")]


def _body(page: list[tuple[str, bool, bool]]) -> str:
    return " ".join(text for text, _, skipped in page if not skipped)


def _marks_article(page: list[tuple[str, bool, bool]]) -> bool:
    return any(inside and not skipped for _, inside, skipped in page)


def _text(page: list[tuple[str, bool, bool]], cover: np.ndarray | None) -> str:
    """The main text; ``cover`` tells which tokens lie in repeated runs, for pages that mark no article."""
    marked = _marks_article(page)
    kept, at = [], 0
    for text, inside, skipped in page:
        if not marked and cover is not None:
            words = text.split(" ")
            here = cover[at : at + len(words)]
            at += len(words)
            if not skipped and here.any():
                text = " ".join(w for w, c in zip(words, here) if not c)
        if skipped or marked and not inside:
            continue
        if text:
            kept.append(text)
    return BETWEEN.join(kept)


def _without(text: str, covered: dict[int, np.ndarray]) -> str:
    """An article's text without the blocks, told by their place, that runs from the given places on cover wholly;
    as it is, if these are half of it or more."""
    parts = text.split(BETWEEN)
    out = set()
    for place, begins in covered.items():
        n = parts[place].count(" ") + 1
        steps = np.diff(np.concatenate(([-MIN_RUN], np.unique(begins), [n])))
        if steps.max() <= MIN_RUN and steps[0] == MIN_RUN:  # the first begins it, no gap, the last one ends it
            out.add(place)
    return text if 2 * sum(len(parts[i]) for i in out) >= sum(map(len, parts)) else BETWEEN.join(t for i, t in enumerate(parts) if i not in out)


def _outside(page: list[tuple[str, bool, bool]]) -> list[str]:
    """Blocks long enough to hold a run that stand in marked elements or beside the page's article."""
    marked = _marks_article(page)
    return [text for text, inside, skipped in page if (skipped or marked and not inside) and text.count(" ") + 1 >= MIN_RUN]


def _family(page: list[tuple[str, bool, bool]]) -> int:
    return xxhash.xxh3_64_intdigest(_body(page).encode()) - (1 << 63)


def main_texts(pages: list[list[tuple[str, bool, bool]]]) -> list[str]:
    """The main text of every page of one host."""
    same: dict[str, int] = {}
    families = [same.setdefault(b, len(same)) for b in map(_body, pages)]
    texts = [_text(page, cover) for page, cover in zip(pages, repeated([_tokens(p) for p in pages], families))]
    holders: dict[tuple, set[int]] = {}
    for page, family in zip(pages, families):
        for words in (text.split(" ") for text in _outside(page)):
            for at in range(len(words) - MIN_RUN + 1):
                holders.setdefault(tuple(words[at : at + MIN_RUN]), set()).add(family)
    for i, page in enumerate(pages):
        if _marks_article(page):
            covered = {}
            for place, words in enumerate(t.split(" ") for t in texts[i].split(BETWEEN)):
                runs = (holders.get(tuple(words[at : at + MIN_RUN]), ()) for at in range(len(words) - MIN_RUN + 1))
                if begins := [at for at, held in enumerate(runs) if len(held) >= max(LEAST_PAGES, len(same) / 2)]:
                    covered[place] = np.array(begins)
            texts[i] = _without(texts[i], covered)
    return texts


def _runs(host: str, page: list[tuple[str, bool, bool]]) -> np.ndarray:
    """The 128-bit hash of host and run, as two longs, for the run of ``MIN_RUN`` tokens at each place of the page."""
    tokens = [t.encode() for t in _tokens(page)]
    joined, start = b" ".join(tokens), xxhash.xxh3_64_intdigest(host.encode())
    ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
    spans = zip([0, *ends], ends[MIN_RUN - 1 :])
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(joined[a : b - 1], start) for a, b in spans), dtype="<i8").reshape(-1, 2)


def _in_batches(parts, names: list[str]):
    """Record batches of at least ``RUNS_AT_ONCE`` rows, and the rest, from lists of equally long arrays."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= RUNS_AT_ONCE:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held)], names)
            held, n = [], 0
    if n:
        yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held)], names)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page."""
    parts = "array<struct<text string, inside boolean, skipped boolean>>"
    kinds = pa.list_(pa.struct([("text", pa.string()), ("inside", pa.bool_()), ("skipped", pa.bool_())]))
    fields = ("text", "inside", "skipped")
    held = lambda page: [(b["text"], b["inside"], b["skipped"]) for b in page]

    def read(batches):
        for batch in batches:
            texts, open_pages, outside, families = [], [], [], []
            for h in batch.column(3).to_pylist():
                page = blocks(h)
                judged = bool(page) and not _marks_article(page)  # by repetition
                texts.append(None if judged else _text(page, None))
                open_pages.append([dict(zip(fields, b)) for b in page] if judged else None)
                outside.append(_outside(page))
                families.append(_family(page))
            columns = [pa.array(texts, pa.string()), pa.array(open_pages, kinds), pa.array(outside, pa.list_(pa.string())), pa.array(families, pa.int64())]
            yield pa.record_batch([*batch.columns[:3], *columns], ["page_id", "url", "host", "text", "blocks", "outside", "family"])

    def runs_of_open(batches):
        def found(batch):
            for row, host, page in zip(*(batch.column(c).to_pylist() for c in range(3))):
                page = held(page)
                keys = _runs(host, page)
                family = np.full(len(keys), np.int64(_family(page)))
                yield np.full(len(keys), row), np.arange(len(keys)), keys[:, 0], keys[:, 1], family

        for batch in batches:
            yield from _in_batches(found(batch), ["row", "at", "k1", "k2", "family"])

    def runs_of_marked(batches):
        def found(batch):
            for host, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = blocks(h)
                if _marks_article(page):
                    keys = np.unique(_runs(host, page), axis=0)
                    family = np.full(len(keys), np.int64(_family(page)))
                    yield keys[:, 0], keys[:, 1], family

        for batch in batches:
            yield from _in_batches(found(batch), ["k1", "k2", "family"])

    def runs_outside(batches):
        def found(batch):
            for host, family, texts in zip(*(batch.column(c).to_pylist() for c in range(3))):
                keys = np.unique(np.concatenate([_runs(host, [(t, False, True)]) for t in texts]), axis=0)
                yield keys[:, 0], keys[:, 1], np.full(len(keys), np.int64(family))

        for batch in batches:
            yield from _in_batches(found(batch), ["k1", "k2", "family"])

    def runs_of_blocks(batches):
        """The first run of each block, or all runs of the blocks in a fifth column."""

        def found(batch):
            asked = batch.column(4).to_pylist() if batch.num_columns > 4 else [None] * batch.num_rows
            for row, host, least, text, places in zip(*(batch.column(c).to_pylist() for c in range(4)), asked):
                parts = text.split(BETWEEN)
                for place in range(len(parts)) if places is None else places:
                    part = parts[place] if places is not None else " ".join(parts[place].split(" ", MIN_RUN)[:MIN_RUN])
                    if len(keys := _runs(host, [(part, True, False)])):
                        n = len(keys)
                        yield np.full(n, row), np.full(n, place), np.arange(n), keys[:, 0], keys[:, 1], np.full(n, least)

        for batch in batches:
            yield from _in_batches(found(batch), ["row", "place", "at", "k1", "k2", "needed"])

    def take_out(batches):
        for batch in batches:
            texts = []
            for text, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                covered: dict[int, list[int]] = {}
                for run in runs or ():
                    covered.setdefault(run["place"], []).append(run["at"])
                texts.append(_without(text, covered))
            yield pa.record_batch([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    def held_outside(runs: DataFrame, pages: DataFrame) -> DataFrame:
        """The runs that enough pages of the host hold outside their article."""
        beside = pages.where(F.size("outside") > 0).select("host", "family", "outside").mapInArrow(runs_outside, "k1 long, k2 long, family long")
        spread = beside.distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
        return runs.join(spread, ["k1", "k2"]).where(F.col("n") >= F.col("needed"))

    def judge(batches):
        for batch in batches:
            texts = []
            for page, begins in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                page = held(page)
                change = np.zeros(len(_tokens(page)) + 1, dtype=np.int64)
                begins = np.array(begins or [], dtype=np.int64)
                change[begins] += 1  # a place begins one run at most
                change[begins + MIN_RUN] -= 1
                texts.append(_text(page, np.cumsum(change[:-1]) > 0))
            yield pa.record_batch([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    url = F.col(url_col).cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    found = rows.mapInArrow(read, f"page_id long, url string, host string, text string, blocks {parts}, outside array<string>, family long")
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "html-blocks")  # numbered once, then read
    result = ["page_id", "url", "text", F.length("text").cast("long").alias("n_chars")]
    direct = found.where(F.col("blocks").isNull())
    places = "row long, place long, at long, k1 long, k2 long, needed long"
    half = F.ceil(F.count(F.lit(1)) / 2).cast("long")
    hosts = found.select("host", "family").distinct().groupBy("host").agg(F.greatest(half, F.lit(LEAST_PAGES)).alias("needed"))
    holders = found.where(F.size("outside") > 0).select("host", "family").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    asked = stored(hosts.join(holders, "host").where(F.col("n") >= F.col("needed")).drop("n"), "html-hosts")  # hosts that can have such runs
    of_articles = direct.where(F.col("text") != "").join(broadcast_if_small(asked), "host").select("row", "host", "needed", "text")
    begun = held_outside(of_articles.mapInArrow(runs_of_blocks, places), found.join(broadcast_if_small(asked), "host", "left_semi"))
    begun = stored(begun.groupBy("row").agg(F.collect_list("place").alias("places")), "html-begun")  # of one page
    if begun.isEmpty():
        direct = direct.select(*result)
    else:
        runs = of_articles.join(broadcast_if_small(begun, FEW_PAGES), "row").select("row", "host", "needed", "text", "places").mapInArrow(runs_of_blocks, places)
        again = stored(of_articles.join(broadcast_if_small(begun, FEW_PAGES), "row", "left_semi").select("host").distinct(), "html-hosts")
        runs = held_outside(runs, found.join(broadcast_if_small(again), "host", "left_semi"))
        covers = stored(runs.groupBy("row").agg(F.collect_list(F.struct("place", "at")).alias("runs")), "html-covers")
        judged_too = direct.join(broadcast_if_small(covers, FEW_PAGES), "row", "left").select("page_id", "url", "text", "runs")
        direct = judged_too.mapInArrow(take_out, "page_id long, url string, text string").select(*result)
    judged = found.where(F.col("blocks").isNotNull())
    if judged.isEmpty():
        return direct
    own = judged.select("row", "host", "blocks").mapInArrow(runs_of_open, "row long, at long, k1 long, k2 long, family long")
    own = stored(own, "html-runs")
    hosts = stored(judged.select(F.col("host").alias("asked")).distinct(), "html-hosts")
    others = rows.join(hosts, rows.host == hosts.asked, "left_semi").select("host", "html").mapInArrow(runs_of_marked, "k1 long, k2 long, family long")
    spread = own.select("k1", "k2", "family").union(others).groupBy("k1", "k2").agg(F.min("family").alias("least"), F.max("family").alias("most"))
    shared = spread.where(F.col("least") < F.col("most")).select("k1", "k2")
    begins = own.join(shared, ["k1", "k2"], "left_semi").groupBy("row").agg(F.collect_list("at").alias("begins"))  # of one page
    asked = judged.join(begins, "row", "left").select("page_id", "url", "blocks", "begins")
    return direct.union(asked.mapInArrow(judge, "page_id long, url string, text string").select(*result))
