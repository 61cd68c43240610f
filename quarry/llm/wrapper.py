"""HTML main-text extraction by wrapper induction.

Pages of one host are aligned by simple tree matching (two trees match if their
roots do; their children are aligned in order by dynamic programming over the
children's own matchings). Every task folds its pages of a host into one
template tree: matched nodes add up their statistics, unmatched ones are
inserted. The tasks' templates of a host are merged by the same matching, in
two rounds, so a host with a third of all pages meets in no task. All pages
take part; nothing is sampled.

Runs of siblings with one signature fold into one node, so lists and
paragraphs of any length align as one slot.

A template node whose text is the same on most pages of the host is constant:
template. While pages are folded, a node keeps a few frequent texts by
Misra-Gries counting, which merges in any order and says by how much it may
have undercounted. Where that leaves open whether a node is constant, the
pages of its host are counted once more, exactly. A varying node is a slot. Slots are content unless they are links for
the most part or lie in an element that says it is something else (navigation,
footer, aside, form, advert, comments ...). The main text is what the content
slots of the host's main element hold on a page: its ``article`` or ``main``
element, or else the element with most varying content. A page is aligned to
its host's template to find its slots. Inside a declared main element only blocks
go as constant whose text is the template's on this page as well, and none where
nothing would remain, so hosts of one page or of copies lose nothing.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import dom
from quarry.llm.common import saved
from quarry.llm.dom import Node
from quarry.llm.urls import host_of

CONSTANT_SHARE = 0.8  # of a host's pages with the same text in a node
CONSTANT_PAGES = 3  # pages that show it at least
VOTES = 4  # frequent texts kept of a node
LINK_SHARE = 0.5  # of a slot's characters that are link text
MANY_CHILDREN = 40  # beyond, siblings fold by signature wherever they stand
BROADCAST_BYTES = 32 << 20  # of all templates
SALTS = 128  # keys over which a hot host is dealt
SHAPE = ["host", "template", "pages"]
MERGE_FAN = 64  # templates of one host merged at once in the first round
# Elements and names that are not main text.
APART_TAGS = frozenset("nav footer aside form header head button menu dialog label fieldset audio video".split())
APART_NAMES = re.compile(
    r"(?:^|[\s|_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promoted|nav|navbar|navigation|menu|menus|"
    r"sidebar|side|footer|header|masthead|breadcrumb|breadcrumbs|cookie|cookies|consent|notice|notices|gdpr|popup|modal|overlay|alert|"
    r"comment|comments|commentlist|disqus|respond|reply|replies|discussion|share|sharing|social|related|recommended|recommendations|"
    r"newsletter|subscribe|subscription|signup|login|search|widget|widgets|tags|pagination|pager|toolbar|complementary|contentinfo|skip|copyright)(?:$|[\s|_-])"
)
# Names of readers' text: unlike "sidebar" or "header", hardly ever those of a layout around the main text.
READER_NAMES = re.compile(r"(?:^|[\s|_-])(?:comment|comments|commentlist|disqus|respond|reply|replies|discussion|related|recommended|recommendations)(?:$|[\s|_-])")
LAYOUT_SHARE = 0.8  # of the host's varying text in an element that its name does not part
MAIN_TAGS = ("article", "main")
MAIN_NAMES = re.compile(r"(?:^|[\s|_-])(?:article|post|entry|story|content|main|body-text)(?:$|[\s|_-])")


def apart(node) -> bool:
    """Does the element itself say that it is not main text?"""
    if node.tag in APART_TAGS:
        return True
    return "|" in node.sig and node.tag not in ("body", "html", "article", "main") and bool(APART_NAMES.search(node.sig.split("|", 1)[1]))


class Slot:
    """A template node: how many pages show it, and what text they have in it.

    ``votes`` holds at most ``VOTES`` text hashes with their counts, each short
    of the true one by ``lost`` at most; a text that is not held has no more than that.
    """

    __slots__ = ("chars", "kids", "link", "lost", "members", "own", "pages", "sig", "tag", "votes")

    def __init__(self, sig: str):
        self.sig, self.tag = sig, sig.split("|", 1)[0]
        self.pages = self.chars = self.link = self.lost = 0
        self.votes: dict[int, int] = {}
        self.kids: list[Slot] = []
        self.members: list[Node] = []
        self.own = ""

    @property
    def common(self) -> int | None:
        """The most frequent text's hash (ties: the smallest)."""
        return min(self.votes, key=lambda h: (-self.votes[h], h), default=None)

    def vote(self, votes: dict[int, int], lost: int) -> None:
        for h, n in votes.items():
            self.votes[h] = self.votes.get(h, 0) + n
        self.lost += lost
        if len(self.votes) > VOTES:
            off = sorted(self.votes.values(), reverse=True)[VOTES]
            self.votes = {h: n - off for h, n in self.votes.items() if n > off}
            self.lost += off

    def constant(self) -> bool | None:
        """Is its text the same on most of its pages? None if the counts leave it open."""
        least = max(CONSTANT_PAGES, CONSTANT_SHARE * self.pages)
        most = self.votes.get(self.common, 0)
        return True if most >= least else None if most + self.lost >= least else False

    def dump(self) -> list:
        return [self.sig, self.pages, self.chars, self.link, sorted(self.votes.items()), self.lost, [k.dump() for k in self.kids]]

    @staticmethod
    def load(x: list) -> Slot:
        s = Slot(x[0])
        s.pages, s.chars, s.link = x[1:4]
        s.votes, s.lost = dict(map(tuple, x[4])), x[5]
        s.kids = [Slot.load(k) for k in x[6]]
        return s


def _fold(slots: list[Slot]) -> list[Slot]:
    """Runs of one signature as one slot (any places, if there are many)."""
    many = len({id(s) for s in slots}) > MANY_CHILDREN
    out: list[Slot] = []
    by_sig: dict[str, Slot] = {}
    for s in slots:
        before = by_sig.get(s.sig) if many else (out[-1] if out and out[-1].sig == s.sig else None)
        if before is None:
            out.append(s)
            by_sig[s.sig] = s
        else:
            before.members += s.members
            before.own += "\n" + s.own if s.own else ""
            before.chars += s.chars
            before.link += s.link
            before.kids = before.kids + s.kids
    return out


def condense(node: Node, in_link: bool = False) -> Slot:
    """A page's tree as slots of one page, sibling runs folded, with text statistics."""
    s = Slot(node.sig)
    s.members, s.pages = [node], 1
    in_link = in_link or node.tag == "a"
    texts = []
    for item in node.items:
        if isinstance(item, str):
            texts.append(item)
        elif item.tag not in dom.VOID:
            s.kids.append(condense(item, in_link))
    s.own = " ".join("".join(texts).split())
    s.chars = len(s.own)
    s.link = s.chars if in_link else 0
    return s


def _settle(s: Slot) -> Slot:
    """Fold the children top-down (folding parents first joins their children) and note the own text's hash."""
    s.kids = [_settle(k) for k in _fold(s.kids)]
    if s.own:
        s.votes = {zlib.crc32(s.own.encode("utf-8", "surrogatepass")): 1}
    return s


def page_slots(page: str | None) -> tuple[Node, Slot]:
    root = dom.parse(page)
    return root, _settle(condense(root))


def match(a: Slot, b: Slot, scores: dict) -> int:
    """Simple tree matching: nodes in the largest order-preserving matching of two trees with matching roots."""
    key = (id(a), id(b))
    known = scores.get(key)
    if known is None:
        known = scores[key] = 1 + _children(a, b, scores)[0] if a.sig == b.sig else 0
    return known


def _children(a: Slot, b: Slot, scores: dict) -> tuple[int, list[tuple[int, int]]]:
    """Best alignment of the children, and the matched places."""
    x, y = a.kids, b.kids
    if [s.sig for s in x] == [s.sig for s in y]:  # then no alignment matches more children
        return sum(match(p, q, scores) for p, q in zip(x, y, strict=True)), [(i, i) for i in range(len(x))]
    if not x or not y:
        return 0, []
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        row, nxt = best[i], best[i + 1]
        for j, q in enumerate(y):
            top = row[j + 1] if row[j + 1] >= nxt[j] else nxt[j]
            if p.sig == q.sig:
                both = row[j] + match(p, q, scores)
                top = both if both > top else top
            nxt[j + 1] = top
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[len(x)][len(y)], pairs[::-1]


def merge(template: Slot, other: Slot, scores: dict | None = None) -> None:
    """Fold ``other`` into ``template`` (equal roots): add matched nodes up, insert the rest where it stands."""
    scores = {} if scores is None else scores
    template.pages += other.pages
    template.chars += other.chars
    template.link += other.link
    template.vote(other.votes, other.lost)
    _, pairs = _children(template, other, scores)
    to = {j: i for i, j in pairs}
    kids, at = [], 0
    for j, kid in enumerate(other.kids):
        i = to.get(j)
        if i is None:
            kids.append(kid)
            continue
        kids += template.kids[at:i]
        merge(template.kids[i], kid, scores)
        kids.append(template.kids[i])
        at = i + 1
    template.kids = kids + template.kids[at:]


def _bare(s: Slot) -> Slot:
    """Drop the page's own nodes and texts: only statistics stay in a template."""
    s.members, s.own = [], ""
    for k in s.kids:
        _bare(k)
    return s


def _all(s: Slot) -> Iterator[Slot]:
    yield s
    for k in s.kids:
        yield from _all(k)


class Wrapper:
    """A host's template with its nodes judged."""

    def __init__(self, template: Slot):
        self.template = template
        self.main: set[int] = set()
        self.constant: set[int] = set()
        self.open: set[int] = set()  # set apart by name, yet around the main text (class="has-sidebar")
        self._judge(template)
        self._open_layouts(template)
        declared = self._declared(template, MAIN_TAGS[:1]) or self._declared(template, MAIN_TAGS[1:])
        named = [] if declared else self._named(template)
        self.declared = bool(declared)
        for s in declared or named or [self._heaviest(template)]:
            self.main.add(id(s))

    def _judge(self, s: Slot) -> None:
        if s.constant():
            self.constant.add(id(s))
        for k in s.kids:
            self._judge(k)

    def _apart(self, s: Slot) -> bool:
        return id(s) not in self.open and apart(s)

    def _open_layouts(self, root: Slot) -> None:
        """Find elements that only their name sets apart but that hold nearly all the varying text, or an article or main with more than all that is not apart."""
        bulk: dict[int, int] = {}

        def weigh(s: Slot, varying: bool) -> int:
            own = s.chars - s.link if not (varying and id(s) in self.constant) else 0
            bulk[id(s)] = 0 if s.tag in APART_TAGS else own + sum([weigh(k, varying) for k in s.kids])
            return bulk[id(s)]

        def mains(s: Slot) -> list[Slot]:
            return [] if s.tag in APART_TAGS else [s] if s.tag in MAIN_TAGS else [x for k in s.kids for x in mains(k)]

        varying = bool(weigh(root, True)) or not weigh(root, False)
        rest, todo = self._mass(root, varying), [root]
        while todo:
            s = todo.pop()
            if s.tag in APART_TAGS or not bulk[id(s)]:
                continue
            if apart(s):
                layout = bulk[id(s)] >= LAYOUT_SHARE * bulk[id(root)] and not READER_NAMES.search(s.sig.split("|", 1)[1])
                if not layout and all(self._mass(x, varying) <= rest for x in mains(s)):
                    continue
                self.open.add(id(s))
                rest = self._mass(root, varying)
            todo += sorted(s.kids, key=lambda k: bulk[id(k)])  # the heaviest first

    def _declared(self, s: Slot, tags) -> list[Slot]:
        if self._apart(s):
            return []
        if s.tag in tags and self.mass(s):
            return [s]
        return [x for k in s.kids for x in self._declared(k, tags)]

    def _named(self, s: Slot) -> list[Slot]:
        """The named content element with most of the page's content, if that is most of it."""
        found: list[Slot] = []

        def walk(x: Slot) -> None:
            if not self._apart(x):
                if "|" in x.sig and x.tag not in ("body", "html") and MAIN_NAMES.search(x.sig.split("|", 1)[1]):
                    found.append(x)
                for k in x.kids:
                    walk(k)

        walk(s)
        best = max(found, key=self.mass, default=None)
        return [best] if best is not None and self.mass(best) > 0.5 * self.mass(s) else []

    def mass(self, s: Slot) -> int:
        """Characters of varying, unlinked text below a node, without what lies apart; of constant text if none varies."""
        return self._mass(s, True) or self._mass(s, False)

    def _mass(self, s: Slot, varying: bool) -> int:
        if self._apart(s):
            return 0
        own = s.chars - s.link if not (varying and id(s) in self.constant) else 0
        return own + sum(self._mass(k, varying) for k in s.kids)

    def _heaviest(self, s: Slot) -> Slot:
        """Descend while one child element holds nearly all content."""
        while True:
            total = self.mass(s)
            kid = max(s.kids, key=self.mass, default=None)
            if kid is None or not total or self.mass(kid) < 0.8 * total or kid.tag not in dom.BLOCKS | {"#"} or kid.tag in ("p", "h1", "h2", "h3"):
                return s
            s = kid

    def text(self, page: str | None) -> str:
        """The main text of a page: blocks in page order, one a line."""
        root, slots = page_slots(page)
        chosen: dict[int, bool] = {}
        self._choose(slots, self.template, {}, False, False, chosen)
        if self.declared and not any(s.own and chosen[id(s.members[0])] for s in _all(slots)):  # its whole main text is constant: a copy
            chosen = {}
            self._choose(slots, self.template, {}, False, False, chosen, spare=True)
        if not any(chosen.values()):  # the page lacks the host's main element: it is its own template
            own = Wrapper(slots) if self.template is not slots else self
            if own is not self:
                chosen = {}
                own._choose(slots, slots, {}, False, False, chosen)
        return "\n".join(dom.blocks(root, lambda n: chosen.get(id(n), False)))

    def _choose(self, s: Slot, t: Slot | None, scores: dict, inside: bool, parted: bool, chosen: dict, spare: bool = False, running: bool = False) -> None:
        """Decide for every page node, by the template node it aligns to, whether its own text is content.

        ``spare``: constant text stays. ``running``: the parent's own text is
        content, and inline elements in a declared main element are part of it.
        """
        parted = parted or (self._apart(t) if t is not None else apart(s))
        if t is not None and id(t) in self.main:
            inside, parted = True, False
        wanted = inside and not parted
        if wanted and t is not None and id(t) in self.constant and not spare:
            wanted = self.declared and (s.common != t.common or (running and s.tag not in dom.BLOCKS))
        if wanted and t is not None and t.tag in ("ul", "ol", "div", "section", "table") and not (t.chars - t.link) and self._links(t):
            parted, wanted = True, False
        for node in s.members:
            chosen[id(node)] = wanted
        to = {}
        if t is not None:
            to = {i: t.kids[j] for i, j in _children(s, t, scores)[1]}
        running = wanted and (bool(s.own) or (running and s.tag not in dom.BLOCKS))
        for i, kid in enumerate(s.kids):
            self._choose(kid, to.get(i), scores, inside, parted, chosen, spare, running)

    @staticmethod
    def _links(t: Slot) -> bool:
        chars = link = 0
        todo = [t]
        while todo:
            x = todo.pop()
            chars, link = chars + x.chars, link + x.link
            todo += x.kids
        return chars > 0 and link > LINK_SHARE * chars


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Slot] = {}

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([json.dumps(s.dump()) for s in found.values()], pa.string()), pa.array([s.pages for s in found.values()], pa.int64())], SHAPE)
        found.clear()
        return made

    for batch in batches:
        for host, page in zip(batch["host"].to_pylist(), batch["html"], strict=True):
            slots = _bare(page_slots(page.as_py())[1])
            if host in found:
                merge(found[host], slots)
            else:
                found[host] = slots
        if len(found) > 2000:
            yield out()
    if found:
        yield out()


def _tally(t: Slot) -> list[int]:
    """Per template node in tree order, 0 twice: pages seen, and those with its most frequent text."""
    return [0] * (2 * sum(1 for _ in _all(t)))


def _recount(s: Slot, t: Slot, places: dict[int, int], tally: list[int], scores: dict) -> None:
    """Add one page, aligned to its host's template, to the template's tally."""
    at = places[id(t)]
    tally[2 * at] += 1
    tally[2 * at + 1] += bool(s.votes) and s.common == t.common
    for i, j in _children(s, t, scores)[1]:
        _recount(s.kids[i], t.kids[j], places, tally, scores)


def _counted(template: str, tally: list[int]) -> str:
    """The template with exact counts in place of estimates."""
    t = Slot.load(json.loads(template))
    for at, s in enumerate(_all(t)):
        s.pages, s.votes, s.lost = tally[2 * at], {s.common: tally[2 * at + 1]} if s.votes else {}, 0
    return json.dumps(t.dump())


def settled(pages: DataFrame, templates: DataFrame, html_col: str) -> DataFrame:
    """``templates`` with every node's constancy known: the hosts that leave it open for a node are counted once more.

    ``pages`` has ``__host`` beside the page. A task adds its pages of a host up
    to one tally, and tallies add up in an aggregation.
    """
    unsure = F.arrow_udf(_unsure, "boolean")(F.col("template"))
    judged = saved(templates.withColumn("unsure", unsure), "templates")
    again = judged.where("unsure").drop("unsure")
    if again.isEmpty():
        return judged.drop("unsure")
    rows, named, keys = _beside(pages.select("__host", html_col), again, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Slot, dict[int, int], list[int]]] = {}
        for batch in batches:
            for host, template, page in zip(batch["__host"].to_pylist(), batch["__template"], batch[html_col], strict=True):
                if host not in known:
                    t = Slot.load(json.loads(template.as_py()))
                    known[host] = t, {id(x): at for at, x in enumerate(_all(t))}, _tally(t)
                t, places, tally = known[host]
                _recount(page_slots(page.as_py())[1], t, places, tally, {})
            yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array([x[2] for x in known.values()], pa.list_(pa.int64()))], ["host", "tally"])
            known.clear()

    met = rows.join(named, keys).select("__host", "__template", html_col)
    tallies = met.mapInArrow(run, "host string, tally array<long>").select("host", F.posexplode("tally").alias("at", "n"))
    summed = tallies.groupBy("host", "at").agg(F.sum("n").alias("n"))
    listed = summed.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "n"))), lambda x: x["n"]).alias("tally"))

    def exact(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for template, tally in batches:
            yield pa.array([_counted(t, n) for t, n in zip(template.to_pylist(), tally.to_pylist(), strict=True)], pa.string())

    exact.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    done = again.join(listed, "host").withColumn("template", F.arrow_udf(exact, "string")(F.col("template"), F.col("tally"))).drop("tally")
    return saved(judged.where("NOT unsure").drop("unsure").unionByName(done), "templates")


def _unsure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([any(s.constant() is None for s in _all(Slot.load(json.loads(t)))) for t in batch.to_pylist()], pa.bool_())


_unsure.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def _merge_group(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
    template: Slot | None = None
    for x in sorted(batch["template"].to_pylist()):  # one result whatever the order of arrival
        other = Slot.load(json.loads(x))
        if template is None:
            template = other
        else:
            merge(template, other)
    return pa.table([[key[0].as_py()], [json.dumps(template.dump())], [template.pages]], SHAPE)


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``template`` (as JSON) and ``pages`` (their count): one template per host, from all its pages."""
    shape = "host string, template string, pages long"
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    partial = rows.mapInArrow(_induce, shape)
    first = partial.withColumn("lot", F.pmod(F.xxhash64("template"), F.lit(MERGE_FAN)))
    first = first.groupBy("host", "lot").applyInArrow(_merge_group, shape)
    return first.groupBy("host").applyInArrow(_merge_group, shape)


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Add ``out_col`` string: the main text of every page (empty for a null or empty page).

    Pages without a host (null URL or no ``://``) share the empty host. Pages
    are judged one by one against their host's template; repeated rows repeat.
    A column already named ``out_col`` is replaced.
    """
    hosted = pages.withColumn("__host", host_of(F.col(url_col)))
    pages, templates, keys = _beside(hosted, settled(hosted, induce(pages, url_col, html_col), html_col), html_col)
    known: dict[str, Wrapper] = {}

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for template, page in batches:
            out = []
            for t, p in zip(template.to_pylist(), page, strict=True):
                if t not in known:
                    if len(known) > 500:
                        known.clear()
                    known[t] = Wrapper(Slot.load(json.loads(t)) if t else page_slots(p.as_py())[1])
                out.append(known[t].text(p.as_py()))
            yield pa.array(out, pa.string())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    joined = pages.join(templates, keys, "left")
    return joined.withColumn(out_col, F.arrow_udf(run, "string")(F.col("__template"), F.col(html_col))).drop("__template", *keys)


def _beside(pages: DataFrame, templates: DataFrame, html_col: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of the join of pages (``__host``) with their templates, and its keys.

    Templates measured at ``BROADCAST_BYTES`` or less go to the pages. Beyond,
    both sides shuffle by host, and the hosts with a hundredth of all pages or
    more (a hundred at most) are dealt over ``SALTS`` keys.
    """
    bytes_, count = templates.agg(F.coalesce(F.sum(F.octet_length("template")), F.lit(0)), F.coalesce(F.sum("pages"), F.lit(0))).first()
    named = templates.select(F.col("host").alias("__host"), F.col("template").alias("__template"), "pages")
    if bytes_ <= BROADCAST_BYTES:
        return pages, F.broadcast(named.drop("pages")), ["__host"]
    hot = [r[0] for r in named.where(F.col("pages") * 100 >= count).select("__host").collect()]
    often = F.col("__host").isin(hot)
    dealt = pages.withColumn("__salt", F.when(often, F.pmod(F.xxhash64(html_col), F.lit(SALTS))).otherwise(F.lit(0).cast("long")))
    salts = F.when(often, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return dealt, named.select("__host", "__template", F.explode(salts).alias("__salt")), ["__host", "__salt"]
