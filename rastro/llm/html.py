"""Operator 4, main text of web pages: markup decides what it can, a host's suffix array the rest.

Pages of a host share a template. Their token streams (tags and words) are put in a row, suffixes are sorted by
their first ``REPEAT`` tokens with prefix doubling, and token runs that occur on several pages of the host are
its boilerplate. Outside an article element, covered tokens go and unique runs stay.

By itself the repetition cannot tell an article that was published twice from a notice, nor a menu with links
of its own from text. So markup comes first: an article (or main) element is the text; menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments never are, wherever they
stand. An article in a wrapper that only its class or id calls one of these opens a scope of its own. Repetition decides on the pages, and the parts of pages, that markup says nothing about.

Pages stay where they are read: each task cuts its rows into groups of up to ``GROUP_PAGES``, parses each page once and sorts
the suffixes of a group, within each host. Html is not shuffled. Groups travel as compressed arrays of tokens, and compare
their runs with those of all other groups in two steps:

* first by anchors. The anchor of a run is the least hash of its stretches of ``ANCHOR`` tokens, so neighbours share anchors and
  about half as many travel. Hashes are shortened so that most anchors that no other group has are known to be unique;
* then by 64-bit hashes of whole runs, only of those with an anchor that another group has too. A run that each of its groups
  has on two pages already need not be asked for.

Each page is one result row, and its text does not depend on the groups. A task that is run again must find its rows in the same
order, as it does in files.

Defined results: null or empty html has empty text, a null url is a host of its own. Repeated rows give a row
each; they count as one page where repetition is looked for. Unclosed elements end with the page.
"""

import re
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rastro.llm.packing import compressed, cuts, decompressed, pack, unpack
from rastro.llm.workers import find_package

#: Pages and bytes of html of a group at most; one larger page is a group of its own.
GROUP_PAGES, GROUP_BYTES = 2048, 16 << 20
#: Html per part, of which each compares a range of anchors; a small table has up to ``FEW_PARTS`` smaller parts.
PART_BYTES, LEAST_PART_BYTES, FEW_PARTS = 64 << 20, 1 << 20, 64
#: Not read any more, as pages are not joined with the sizes of their hosts; the name stays for callers that set it.
BROADCAST_HOSTS = 500_000
REPEAT = 8
#: Tokens of an anchor.
ANCHOR = 6
#: Words are compressed harder than all else, as they are most of what is sent.
WORDS_LEVEL = 6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|title|button)\b[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)"
    r"|[^<]++|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements that are never main text.
CHROME = frozenset("nav footer aside form menu dialog".split())
#: Elements whose content is main text.
MAIN = frozenset("article main".split())
#: Elements that are followed from their beginning to their end.
CONTAINERS = CHROME | MAIN | frozenset(
    "header div section ul ol dl li table tr td th tbody span p blockquote figure center fieldset".split()
)
#: Elements inside a line; all others separate blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Class, id or role names of menus, notices, adverts, sidebars, forms and comments: a name as a whole or its first part,
#: also behind a word for the place. Other parts say nothing: has-sidebar and with-menu are wrappers of the article.
_PLACE = r"(?:^|\s)(?:(?:site|main|top|bottom|left|right|global|primary|secondary|mobile)[_-])?"
_TELLING = (
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|gdpr|sidebar|comments?|disqus|share|sharing|newsletter|subscribe"
    r"|signup|breadcrumbs?|nav|navbar|navigation|footer|popup|modal|widgets?|pagination|pager"
)
#: Names that a section of an article can have as its first part.
_LOOSE = r"banner|consent|notices?|respond|social|related|menu|toolbar|login|search|complementary|contentinfo"
_CHROME_NAME = re.compile(rf"{_PLACE}(?:{_TELLING}|{_LOOSE}|alert|nav\w*)(?=$|[\s_-])", re.I)
_CHROME_IN_MAIN = re.compile(
    rf"{_PLACE}(?:{_TELLING}|(?:{_LOOSE})(?=$|\s)|related[_-](?:posts?|articles?|links?|stories|content|news))(?=$|[\s_-])", re.I
)
_HEADER_NAME = re.compile(rf"{_PLACE}(?:header|masthead)(?=$|[\s_-])", re.I)


def _kind(name, attributes, in_main):
    """'main', 'chrome' by its element, 'named' as chrome by class, id or role only, or '' for an element that opens."""
    if name in MAIN:
        return "main"
    if name in CHROME or (name == "header" and not in_main):
        return "chrome"
    names = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(attributes)) if "=" in attributes else ""
    if not names:
        return ""
    if in_main:
        return "named" if _CHROME_IN_MAIN.search(names) else ""
    return "named" if _CHROME_NAME.search(names) or _HEADER_NAME.search(names) else ""


def _inside(scope, kind):
    """Scope (in chrome, in chrome by name, main) within an element of ``kind`` that opens in ``scope``.

    ``main`` is 0, 1, or 2 in a main element that stands in chrome by name only; that opens a scope of its own.
    """
    chrome, named, main = scope
    if kind == "chrome":
        return True, named, main
    if kind == "named":
        return chrome, True, main
    if kind == "main" and not chrome and not main:
        return False, False, 2 if named else 1
    return scope


def parse(html):
    """Tokens of a page and its blocks.

    Returns the tags and words in order, and for each block outside chrome: 1 if it is in a main element, 2 if that
    stands in chrome by name, else 0; its words, and the place of each word among the tokens.
    """
    tokens, blocks, stack = [], [], []
    words, places = [], []
    scope = (False, False, 0)
    glued = False  # the next word continues the last one

    def flush(main):
        nonlocal words, places
        if words:
            blocks.append((main, words, places))
            words, places = [], []

    for match in _TOKEN.finditer(html):
        raw, closing, name = match[1], match[2], match[3]
        if name is None:
            text = match[0]
            if raw is not None or text.startswith(("<!", "<?")):
                if raw is not None and raw.lower() == "title":
                    flush(scope[2])
                continue
            text = unescape(text)
            found = text.split()
            if scope[0] or scope[1]:
                tokens += found
                continue
            if found and glued and words and not text[0].isspace():
                words[-1] += found[0]
                tokens[places[-1]] = words[-1]
                found = found[1:]
            places += range(len(tokens), len(tokens) + len(found))
            words += found
            tokens += found
            if text:
                glued = not text[-1].isspace()
            continue
        name = name.lower()
        tokens.append(f"<{closing}{name}>")
        if name not in INLINE:
            flush(scope[2])
            glued = False
        if name not in CONTAINERS:
            continue
        if not closing:
            if name == "p":
                continue
            if not match[4].rstrip().endswith("/"):
                stack.append((name, scope))
                scope = _inside(scope, _kind(name, match[4], scope[2] > 0))
        elif any(open_name == name for open_name, _ in stack):
            while True:
                open_name, scope = stack.pop()
                if open_name == name:
                    break
    flush(scope[2])
    return tokens, blocks


@dataclass
class Group:
    """Token streams of distinct pages in a row, as arrays."""

    words: list  # the distinct tokens, frequent ones first, those that occur once in their order
    ids: np.ndarray  # the tokens, by their place in ``words``
    sizes: np.ndarray  # tokens per page
    marks: np.ndarray  # per token 0, or 1 + 3 * number of its block + what ``parse`` says of the block
    hosts: np.ndarray  # 64-bit hash of the host per page
    names: np.ndarray  # 64-bit hash of the html per page
    starts: np.ndarray  # for each token if a run begins there that another page of the host in this group has too


def _hashed(texts):
    return hash_array(np.array([*texts, ""], object), categorize=False)[:-1]


def _numbered(tokens):
    """The distinct tokens, frequent ones first, and the place of each token among them."""
    found = pa.array(tokens, pa.string()).dictionary_encode()
    ids = found.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(ids, minlength=len(found.dictionary)), kind="stable")
    return found.dictionary.take(pa.array(order)).to_pylist(), np.argsort(order)[ids]


def _to_end(sizes):
    """For each token, how many are left to the end of its page."""
    return np.repeat(np.cumsum(sizes), sizes) - np.arange(int(sizes.sum()))


def _first_alike(keys, places):
    """For each of ``keys``, at ``places``: the first place with an equal key, and if another place has one."""
    order = np.argsort(keys, kind="stable")
    begins = np.ones(len(keys), bool)
    begins[1:] = keys[order][1:] != keys[order][:-1]
    numbers = np.cumsum(begins) - 1
    first, again = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    first[order] = places[order[begins]][numbers]
    again[order] = (np.bincount(numbers) > 1)[numbers]
    return first, again


def repeated_starts(ids, sizes, hosts, width=REPEAT):
    """For each token if a run of ``width`` tokens begins there that another page of the same host has too.

    Suffixes are sorted by 1, 2, 4 .. tokens; those that are equal so far have the place of their first as rank, and one that
    equals no other is done with.
    """
    n = len(ids)
    starts = np.zeros(n, bool)
    if not n:
        return starts
    _, host = np.unique(hosts, return_inverse=True)
    pages, left = np.repeat(np.arange(len(sizes)), sizes), _to_end(sizes)
    rank, again = _first_alike(ids.astype(np.int64) * (len(hosts) + 1) + host[pages], np.arange(n))
    tied = np.flatnonzero(again)
    have = 1
    while have < width and len(tied):
        # suffixes by twice as many tokens, from their ranks by the first and the second half
        step = min(have, width - have)
        tied = tied[left[tied] >= have + step]
        ranks, again = _first_alike(rank[tied] * n + rank[tied + step], tied)
        # all others equal none that is compared from here on
        rank = np.arange(n)
        rank[tied] = ranks
        tied = tied[again]
        have += step
    tied = tied[left[tied] >= width]
    order = tied[np.argsort(rank[tied], kind="stable")]
    if len(order):
        begins = np.array([a for a, _ in cuts(rank[order])])
        low, high = (f.reduceat(pages[order], begins) for f in (np.minimum, np.maximum))
        starts[order] = np.repeat(low < high, np.diff(np.append(begins, len(order))))
    return starts


def covered_tokens(starts, width=REPEAT):
    """Which tokens lie in a run of ``width`` that begins at one of ``starts``."""
    edges = np.zeros(len(starts) + width, np.int64)
    edges[: len(starts)] += starts
    edges[width:] -= starts
    return np.cumsum(edges)[: len(starts)] > 0


def repeated_tokens(streams, width=REPEAT):
    """For each stream, which tokens lie in a run of ``width`` tokens that another stream has too."""
    sizes = np.array([len(s) for s in streams], np.int64)
    _, ids = _numbered([t for s in streams for t in s])
    covered = covered_tokens(repeated_starts(ids, sizes, np.zeros(len(sizes), np.int64), width), width)
    return np.split(covered, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _group(htmls, hosts):
    """The group of distinct ``htmls`` with their hosts."""
    tokens, sizes, marks = [], [], []
    for html in htmls:
        found, blocks = parse(html)
        mark = np.zeros(len(found), np.int32)
        for i, (main, _, places) in enumerate(blocks):
            mark[places] = 1 + 3 * i + main
        tokens += found
        sizes.append(len(found))
        marks.append(mark)
    words, ids = _numbered(tokens)
    sizes, hosts = np.array(sizes, np.int64), _hashed(hosts)
    digests = [blake2b(h.encode("utf-8", "surrogatepass"), digest_size=8).digest() for h in htmls]
    names = np.frombuffer(b"".join(digests), np.uint64)
    return Group(words, ids, sizes, np.concatenate([np.empty(0, np.int32), *marks]), hosts, names, repeated_starts(ids, sizes, hosts))


def _unique_runs(words, covered):
    """Words of a block without its covered stretches; one that only reaches into the block stays."""
    edges = np.flatnonzero(np.diff(covered, prepend=~covered[:1], append=~covered[-1:]))
    kept = []
    for a, b in zip(edges, edges[1:]):
        if not covered[a] or REPEAT > b - a < len(words):
            kept += words[a:b]
    return kept


def _texts(group, starts):
    """Main text of each page of a group, and how many of its tokens lie in runs of other pages, which begin at ``starts``.

    The runs that no other page has are the text, but for two checks by markup: in pages with a main
    element, its blocks are whole and others go; and chrome goes in all.
    """
    covered = covered_tokens(starts)
    ends = np.cumsum(group.sizes)
    pages = np.repeat(np.arange(len(ends)), group.sizes)
    repeated = np.bincount(pages[covered], minlength=len(ends)).tolist()
    inside = np.flatnonzero(group.marks)
    levels = (group.marks[inside] - 1) % 3
    size = [np.bincount(pages[inside[levels == level]], minlength=len(ends)) for level in (0, 1, 2)]
    # an article in a wrapper named like chrome counts unless the page has another, or more text elsewhere
    marked = np.where(size[1] > 0, 1, np.where(size[2] > size[0], 2, 0))
    wanted = marked[pages[inside]]
    inside = inside[(wanted == 0) | (wanted == levels)]
    words = np.array([*group.words, ""], object)[group.ids[inside]].tolist()
    covered = covered[inside]
    lines = [[] for _ in ends]
    block = pages[inside] * (int(group.marks.max(initial=0)) + 1) + group.marks[inside]
    for a, b in cuts(block):
        page = pages[inside[a]]
        kept = words[a:b] if marked[page] else _unique_runs(words[a:b], covered[a:b])
        if kept:
            lines[page].append(" ".join(kept))
    return ["\n".join(found) for found in lines], repeated


def main_texts(pages):
    """Main text of each html of a host, and how many of its tokens are boilerplate."""
    # repeated rows of a page show nothing about the template
    distinct = {}
    of_page = [distinct.setdefault(html, len(distinct)) for html in pages]
    group = _group(list(distinct), [""] * len(distinct))
    texts, repeated = _texts(group, group.starts)
    return [texts[i] for i in of_page], [repeated[i] for i in of_page]


# --- comparing the groups -------------------------------------------------------------------

_MIX, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(hashes):
    hashes = hashes * _LAST
    return hashes ^ (hashes >> np.uint64(32))


def run_hashes(group):
    """Where the runs of a group begin, their 64-bit hashes, and those of their anchors. All depend on the host.

    The anchor of a run is the least of its stretches of ``ANCHOR`` tokens by hash: equal runs have equal anchors, and
    neighbours often share one.
    """
    flat = _hashed(group.words)[group.ids]
    left = _to_end(group.sizes)
    # mixed, as the name of the host is a token of many pages
    seeds = np.repeat(_mixed(group.hosts), group.sizes)
    whole = np.flatnonzero(left >= REPEAT)
    n = max(len(flat) - ANCHOR + 1, 0)  # a stretch that leaves its page is in no whole run
    hashes = seeds[:n]
    for k in range(ANCHOR):
        hashes = (hashes ^ flat[k : n + k]) * _MIX
        hashes ^= hashes >> np.uint64(29)
    least = hashes[whole]
    for k in range(1, REPEAT - ANCHOR + 1):
        least = np.minimum(least, hashes[whole + k])
    hashes = hashes[whole]
    for k in range(ANCHOR, REPEAT):
        hashes = (hashes ^ flat[whole + k]) * _MIX
        hashes ^= hashes >> np.uint64(29)
    return whole, _mixed(hashes), _mixed(least)


def _packed(numbers):
    """Bytes of increasing numbers, by their differences."""
    return pack(np.diff(numbers, prepend=np.uint64(0)))


def _unpacked(data, n):
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def _told(replies, sender):
    """The places in all replies to a group, in order."""
    found = [_unpacked(r["places"], r["n"]) for r in replies if r["sender"] == sender]
    return np.sort(np.concatenate([np.empty(0, np.uint64), *found])).astype(np.int64)


def _among(numbers, known):
    """Which numbers are among the ordered ``known``."""
    if not len(known):
        return np.zeros(len(numbers), bool)
    return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] == numbers


def _distinct(numbers):
    """Distinct numbers in order; ``np.unique`` hashes them first, which takes several times as long."""
    numbers = np.sort(numbers)
    new = np.ones(len(numbers), bool)
    new[1:] = numbers[1:] != numbers[:-1]
    return numbers[new]


def _bits(flags):
    return pack(np.packbits(flags))


def _flags(data, n):
    return np.unpackbits(unpack(data, -(-n // 8), np.uint8), count=n).astype(bool)


def _dealt(numbers, bits, n_parts):
    """Cuts ordered numbers of ``bits`` bits at the borders of ``n_parts`` ranges: number of the range, begin and end."""
    ranges = ((numbers >> np.uint64(bits - 32)) * np.uint64(n_parts)) >> np.uint64(32)
    return [(int(ranges[a]), a, b) for a, b in cuts(ranges)]


def _arrow(kind):
    return {"bigint": pa.int64(), "binary": pa.binary()}[kind]


def _table(schema, rows):
    """Rows, dicts of some columns of ``schema``."""
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r.get(name) for r in rows], _arrow(kind)) for name, kind in fields})


#: What a group sends: its anchors, and the names of its pages among them, to the part that compares their range, with a bit
#: for each that says if some run with it is on one page only, and the place of the first among all of the group; and itself to
#: its own part, ``home``.
_SENT = (
    "part bigint, sender bigint, home bigint, first bigint, n bigint, runs binary, open binary, "
    "rows binary, pages bigint, tokens bigint, size bigint, words binary, arrays binary, ids binary, marks binary, starts binary"
)
#: Full hashes of runs, a bit for each that is on one page only, a bit for each of these whose page may have a copy in another
#: group, the names of those pages, and the places of the runs among all of the group.
_RUNS = "part bigint, sender bigint, home bigint, n bigint, runs binary, open binary, named binary, names binary, places binary"
#: The places of some of a group's anchors or runs, which are far smaller than the numbers themselves.
_REPLIES = "home bigint, sender bigint, n bigint, places binary"


def _saved(group):
    text = "\n".join(group.words).encode()  # no token has white space
    arrays = np.concatenate([group.sizes, group.hosts.view(np.int64), group.names.view(np.int64)])
    # words that occur once come in their order, so 0 stands for the next of them
    again = int((np.bincount(group.ids, minlength=1) > 1).sum())
    ids = np.where(group.ids < again, group.ids + 1, 0).astype(np.uint32)
    steps = np.diff(group.marks, prepend=np.int32(0))
    return {
        "pages": len(group.sizes), "tokens": len(ids), "size": len(text), "words": compressed(text, WORDS_LEVEL), "arrays": pack(arrays),
        "ids": pack(ids), "marks": pack(steps << 1 ^ steps >> 31), "starts": _bits(group.starts),
    }


def _restored(row):
    n = row["tokens"]
    sizes, hosts, names = unpack(row["arrays"], 3 * row["pages"], np.int64).reshape(3, -1)
    words = decompressed(row["words"], row["size"]).decode().split("\n")
    ids = unpack(row["ids"], n, np.uint32).astype(np.int64) - 1
    once = np.flatnonzero(ids < 0)
    ids[once] = np.arange(len(words) - len(once), len(words))
    steps = unpack(row["marks"], n, np.int32)
    marks = np.cumsum(steps >> 1 ^ -(steps & 1), dtype=np.int32)
    return Group(words, ids, sizes, marks, hosts.view(np.uint64), names.view(np.uint64), _flags(row["starts"], n))


def _cut(batches):
    """The rows of ``batches`` as tables of up to ``GROUP_PAGES`` rows, and about ``GROUP_BYTES`` of html."""
    waiting, rows, held = [], 0, 0
    for batch in batches:
        at = 0
        sizes = pc.fill_null(pc.binary_length(batch.column("_html")), 0).to_numpy(zero_copy_only=False)
        while at < len(sizes):
            space = sizes[at : at + GROUP_PAGES - rows].cumsum() + held
            n = min(int(np.searchsorted(space, GROUP_BYTES)) + 1, len(space))
            waiting.append(batch.slice(at, n))
            at, rows, held = at + n, rows + n, int(space[n - 1])
            if rows >= GROUP_PAGES or held >= GROUP_BYTES:
                yield pa.Table.from_batches(waiting)
                waiting, rows, held = [], 0, 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _short_numbers(anchors, group, bits):
    """The distinct anchors and names of pages of a group, by ``bits`` bits of each."""
    return _distinct(np.concatenate([anchors, group.names]) >> np.uint64(64 - bits))


def _send_groups(n_parts, bits):
    """Parses pages, finds what a group's own pages repeat, and sends the anchors of its runs and the group itself."""

    def run(batches):
        task = TaskContext.get().partitionId()
        for number, table in enumerate(_cut(batches)):
            distinct = {}
            pairs = zip(table.column("_host").to_pylist(), table.column("_html").to_pylist())
            of_row = [distinct.setdefault((host, html or ""), len(distinct)) for host, html in pairs]
            group = _group([html for _, html in distinct], [host for host, _ in distinct])
            keys = table.drop_columns(["_host", "_html"]).append_column("_page", pa.array(of_row, pa.int32()))
            # multiples of the golden ratio: groups are dealt evenly, however many a task has
            home = int((4 * task + number) * 0.6180339887498949 % 1 * n_parts)
            sender = {"sender": task << 32 | number, "home": home}
            rows = [{"part": home, **sender, "rows": _stream(keys), **_saved(group)}]
            whole, _, anchors = run_hashes(group)
            single = _short_numbers(anchors[~group.starts[whole]], group, bits)
            anchors = _short_numbers(anchors, group, bits)
            is_open = _among(anchors, single)
            for part, a, b in _dealt(anchors, bits, n_parts):
                rows.append({"part": part, **sender, "first": a, "n": b - a, "runs": _packed(anchors[a:b]), "open": _bits(is_open[a:b])})
            yield from _table(_SENT, rows).to_batches()

    return run


def _stream(table):
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _groups_in(table):
    return table.filter(pc.is_valid(table.column("rows"))).to_pylist()


def _replies(rows, places, chosen):
    """To the sender of each of ``rows`` those of its places that are ``chosen``, for all rows one after the other."""
    found, begin = [], 0
    for r, own in zip(rows, places):
        own, begin = own[chosen[begin : begin + len(own)]], begin + len(own)
        if len(own):
            found.append({"home": r["home"], "sender": r["sender"], "n": len(own), "places": _packed(own)})
    return _table(_REPLIES, found)


def _find_shared(table):
    """For each group its anchors in one range that another group has too, unless all have each run with it on two pages."""
    rows = table.select(["sender", "home", "first", "n", "runs", "open"]).filter(pc.is_valid(table.column("runs"))).to_pylist()
    listed = [_unpacked(r["runs"], r["n"]) for r in rows]
    is_open = np.concatenate([np.empty(0, bool), *(_flags(r["open"], r["n"]) for r in rows)])
    anchors = np.concatenate([np.empty(0, np.uint64), *listed])
    ordered = np.sort(anchors)
    shared = _distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    places = [np.arange(r["first"], r["first"] + r["n"], dtype=np.uint64) for r in rows]
    return _replies(rows, places, _among(anchors, shared[_among(shared, np.sort(anchors[is_open]))]))


def _send_runs(n_parts, bits):
    """The full hashes of the runs that have an anchor that another group has too."""

    def run(table, replies):
        asked = replies.to_pylist()
        found = []
        for row in _groups_in(table) if asked else []:
            known = _told(asked, row["sender"])
            if not len(known):
                continue
            group = _restored(row)
            shift = np.uint64(64 - bits)
            whole, hashes, anchors = run_hashes(group)
            known = _short_numbers(anchors, group, bits)[known]
            chosen = np.flatnonzero(_among(anchors >> shift, known))
            runs, first = np.unique(hashes[chosen], return_index=True)
            begin = whole[chosen[first]]
            names, is_open = np.repeat(group.names, group.sizes)[begin], ~group.starts[begin]
            named = is_open & _among(names >> shift, known)
            places = np.searchsorted(_distinct(hashes), runs).astype(np.uint64)
            for part, a, b in _dealt(runs, 64, n_parts):
                sent = {"n": b - a, "runs": _packed(runs[a:b]), "open": _bits(is_open[a:b]), "places": _packed(places[a:b])}
                sent |= {"named": _bits(named[a:b]), "names": pack(names[a:b][named[a:b]])}
                found.append({"part": part, "sender": row["sender"], "home": row["home"], **sent})
        return _table(_RUNS, found)

    return run


def _find_repeated(table):
    """For each group, its runs in one range that are on one of its pages and on another page elsewhere."""
    rows = table.to_pylist()
    listed = [_unpacked(r["runs"], r["n"]) for r in rows]
    is_open = [_flags(r["open"], r["n"]) for r in rows]
    low, high = [], []
    for number, (r, single) in enumerate(zip(rows, is_open)):
        named = _flags(r["named"], r["n"])
        names = unpack(r["names"], int(named.sum()), np.uint64)
        # a page without copies elsewhere is another than those of all other groups
        for found, other in ((low, 0), (high, np.iinfo(np.uint64).max)):
            found.append(np.where(single, np.uint64(number), np.uint64(other)))
            found[-1][named] = names
    runs, is_open, low, high = (np.concatenate(x) for x in (listed, is_open, low, high))
    order = np.argsort(runs, kind="stable")
    begins = np.array([a for a, _ in cuts(runs[order])], np.int64)
    twice = np.minimum.reduceat(low[order], begins) < np.maximum.reduceat(high[order], begins)
    places = [_unpacked(r["places"], r["n"]) for r in rows]
    return _replies(rows, places, is_open & _among(runs, runs[order][begins][twice]))


def _extract(schema):
    def run(table, replies):
        told = replies.to_pylist()
        found = []
        for row in _groups_in(table):
            group = _restored(row)
            starts = group.starts
            elsewhere = _told(told, row["sender"])
            if len(elsewhere):
                whole, hashes, _ = run_hashes(group)
                starts[whole[_among(hashes, _distinct(hashes)[elsewhere])]] = True
            texts, repeated = _texts(group, starts)
            keys = pa.ipc.open_stream(row["rows"]).read_all()
            of_row = keys.column("_page").to_pylist()
            kept = keys.drop_columns(["_page"]).append_column("text", pa.array([texts[i] for i in of_row], pa.string()))
            found.append(kept.append_column("n_repeated", pa.array([repeated[i] for i in of_row], pa.int64())))
        return pa.concat_tables(found) if found else schema.empty_table()

    return run


def extract_main_text(pages, html="html", url="url", keys=("page_id", "url")):
    """``keys`` of every page, its ``text``, and ``n_repeated``, its tokens in runs of other pages.

    Measures the html when called.
    """
    find_package(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(*keys, F.col(html).alias("_html"), host.alias("_host"))
    n_bytes = int(rows.agg(F.coalesce(F.sum(F.octet_length("_html")), F.lit(0))).first()[0])
    n_parts = max(n_bytes // PART_BYTES, min(n_bytes // LEAST_PART_BYTES, FEW_PARTS)) + 1
    # a run meets another's short hash by chance in less than 1 of 100 cases, with one anchor for eight bytes of html
    bits = min(max((n_bytes // 8).bit_length() + 7, 32), 64)
    schema = pages.select(*keys).withColumns(
        {"text": F.lit(""), "n_repeated": F.lit(0).cast("long")}
    ).schema
    # the shuffle is made once; all three steps that need anchors or groups read it
    groups = rows.mapInArrow(_send_groups(n_parts, bits), _SENT).groupBy("part")
    shared = groups.applyInArrow(_find_shared, _REPLIES)
    runs = groups.cogroup(shared.groupBy("home")).applyInArrow(_send_runs(n_parts, bits), _RUNS)
    repeated = runs.groupBy("part").applyInArrow(_find_repeated, _REPLIES)
    return groups.cogroup(repeated.groupBy("home")).applyInArrow(_extract(to_arrow_schema(schema)), schema)


def page_report(pages):
    """One row per page: its main text and the number of characters."""
    return extract_main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated"
    )
