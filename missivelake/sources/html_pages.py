"""Conversation pages: text files with one thread each, and the messages in them.

Parsing goes file by file in Arrow batches with the standard parser; everything after it is relational.
"""

from __future__ import annotations

import os
import re
from functools import reduce
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missivelake.functions import text as T
from missivelake.sources.files import inventory
from missivelake.sources.stores import Store, in_task, located, staged

GUID = re.compile(T.GUID)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MESSAGE_SCHEMA = "file string, file_ord long, msg_ord int, guid string, ts_text string, html string"
CHUNK_SCHEMA = (
    "file string, file_ord long, label string, participants array<string>, own_number string, "
    "messages array<struct<ts_iso:string,sender_tel:string,sender_text:string,is_me:boolean,display_name:string,text_html:string,attachments:array<string>>>"
)


def read_pages(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """(file, path, text): whole files; bad bytes become replacement characters.

    Tasks list and read the folders, so that the driver holds no row a file.  Empty files and, below a folder, names that begin
    with a dot or an underscore stay out.
    """
    found = staged(page_list(spark, paths, recursive), "pages")
    total = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    parts = max(1, min(total["n"], max(4 * spark.sparkContext.defaultParallelism, total["bytes"] // READ)))
    read = found.select("path").repartition(parts).mapInArrow(whole_files, "path string, bytes binary")
    return read.select(T.basename(F.col("path")).alias("file"), "path", F.make_valid_utf8(F.col("bytes").cast("string")).alias("text"))


#: Bytes of pages that a task reads at least where there are many, and of those that are passed on together.
READ, TOGETHER = 16 << 20, 4 << 20


def page_list(spark: SparkSession, paths: str | list[str], recursive: bool) -> DataFrame:
    """(path, length): the pages of folders, and named ones, whose length is not asked."""
    named, out = [], []
    for path in [paths] if isinstance(paths, str) else paths:
        store = Store(spark, path)
        if not store.exists(path):
            raise FileNotFoundError(path)
        if not store.is_folder(path):
            named.append((located(spark, path), 0))
            continue
        rows = inventory(spark, path).filter(F.col("rel_path").endswith(".html") & (F.col("length") > 0) & ~F.col("rel_path").rlike("(^|/)[._]"))
        out.append((rows if recursive else rows.filter(~F.col("rel_path").contains("/"))).select("path", "length"))
    if named or not out:
        out.append(spark.createDataFrame([n for n in named if n[0].endswith(".html")], "path string, length long"))
    return reduce(DataFrame.union, out)


def whole_files(batches):
    """(path, bytes) of the files of (path) that are not empty, in batches of bounded size."""
    import pyarrow as pa

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([b for _, b in rows], pa.binary())], names=["path", "bytes"])

    rows, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = in_task(path)
            with store.open_input_stream(at) as stream:
                data = stream.read()
            if not data:
                continue
            if rows and size + len(data) > TOGETHER:
                yield made(rows)
                rows, size = [], 0
            rows.append((path, data))
            size += len(data)
    yield made(rows)


def with_order(pages: DataFrame) -> DataFrame:
    """Adds file_ord, which rises with the file name and, for equal names, the path.  Numbers have gaps."""
    keys = [c for c in ("file", "path") if c in pages.columns]
    names = pages.select(*keys).distinct().orderBy(*keys).withColumn("file_ord", F.monotonically_increasing_id())
    return pages.join(names, keys)


def in_order(spark: SparkSession, paths: list[str], recursive: bool = False) -> DataFrame:
    """(file, file_ord, text) of named pages: file is the whole path, since pages of several runs share their
    base names; file_ord is the place among the inputs."""
    order = spark.createDataFrame([(os.path.abspath(p), i) for i, p in enumerate(dict.fromkeys(paths))], "file string, file_ord long")
    pages = read_pages(spark, [os.path.abspath(p) for p in dict.fromkeys(paths)], recursive).select(F.col("path").alias("file"), "text")
    return pages.join(F.broadcast(order), "file")  # one row a named input


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "start", "end", "order")

    def __init__(self, tag, attrs, parent, start, order):
        self.tag, self.attrs, self.parent, self.start, self.end, self.order = tag, attrs, parent, start, start, order
        self.children: list = []

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def find(self, test):
        """Nodes below, in document order."""
        stack = list(reversed([c for c in self.children if isinstance(c, Node)]))
        while stack:
            n = stack.pop()
            if test(n):
                yield n
            stack.extend(reversed([c for c in n.children if isinstance(c, Node)]))

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()


class Tree(HTMLParser):
    """A tree with the source span of every element, and the comments that hold ids."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.source = source
        self.lines = [0]
        for m in re.finditer("\n", source):
            self.lines.append(m.end())
        self.root = self.here = Node("", {}, None, 0, 0)
        self.count = 0
        self.comments: list[Node] = []
        self.feed(source)
        self.close()
        while self.here is not self.root:
            self.here.end = len(source)
            self.here = self.here.parent
        self.root.end = len(source)

    def at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        self.count += 1
        node = Node(tag, dict(attrs), self.here, self.at(), self.count)
        node.end = node.start + len(self.get_starttag_text() or "")
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.here = self.here.parent

    def handle_endtag(self, tag):
        node = self.here
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is self.root:
            return
        close = self.source.find(">", self.at()) + 1 or len(self.source)
        while self.here is not node:
            self.here.end = self.at()
            self.here = self.here.parent
        node.end = close
        self.here = node.parent

    def handle_data(self, data):
        self.here.children.append(data)

    def handle_comment(self, data):
        if GUID.search(data):
            self.comments.append(self.here)


#: Pages of at least so many characters are cut into blocks of about BLOCK characters, which tasks parse apart.
LARGE, BLOCK = 1 << 22, 1 << 20
#: Places in one block; a block's messages are numbered from a multiple of it.
PLACES = 1_000_000
DIV = re.compile(r"<(/?)div\b([^>]*)>", re.IGNORECASE)
CONTAINER = re.compile(r"""class\s*=\s*["']?[^"'>]*\bmessage\b(?![-\w])""")
#: What hides markup from a scan for elements.
HIDING = re.compile(r"<!--|<!\[|<script\b|<style\b|<textarea\b|<plaintext\b", re.IGNORECASE)


def cuts(source: str, size: int = BLOCK) -> list[int] | None:
    """Where a page can be cut so that its parts, parsed apart, hold the same messages: before message elements that stand beside the
    first one, after at least ``size`` characters each.  None if that is not sure by a scan, or if the page is too short.

    The head before the first message must hold no id and may leave elements open; at least two ids and one in an attribute must
    follow, as else a message could be found by its text or reach beyond its element.
    """
    found, depth, base, at = [], 0, None, 0
    for m in DIV.finditer(source):
        if m[1]:
            depth -= 1
            if base is not None and depth < base - 1:
                break
            continue
        if CONTAINER.search(m[2]) and (base is None or depth == base):
            if base is None:
                base, at = depth, m.start()
                found.append(at)
            elif m.start() - at >= size:
                at = m.start()
                found.append(at)
        depth += not m[2].endswith("/")
    if len(found) < 2 or HIDING.search(source, found[0]) or GUID.search(source, 0, found[0]):
        return None
    last = source.rfind("</div", found[-1])
    if last < 0 or DIV.search(source, last + 6) or depth < 0:
        return None
    ids = {m[0] for m in GUID.finditer(source, found[0])}
    if len(ids) < 2 or not re.search(r"""=\s*["'][^"'<>]*""" + T.GUID, source[found[0] :]):
        return None
    return found


def blocks(pages: DataFrame, large: int = LARGE, size: int = BLOCK) -> DataFrame:
    """(file, file_ord, block, whole, text): pages of at least ``large`` characters in parts dealt to all tasks; a page that cannot be
    cut is one part."""

    def cut(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        for batch in batches:
            for file, order, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = cuts(text, size)
                parts = [text] if at is None else [text[i:j] for i, j in zip(at, [*at[1:], len(text)])]
                for k, part in enumerate(parts):
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((file, order, k, at is None, part), kinds)], names=["file", "file_ord", "block", "whole", "text"])

    rows = pages.select("file", F.col("file_ord").cast("long"), "text").filter(F.length("text") >= large)
    return rows.mapInArrow(cut, "file string, file_ord long, block int, whole boolean, text string").repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def page_parts(spark: SparkSession, folder: str, large: int = LARGE, size: int = BLOCK) -> DataFrame:
    """(file, file_ord, path, block, whole, start, end): the pages of a folder as ranges of bytes that can be parsed apart, dealt to tasks.

    A page of at least ``large`` bytes is cut by one task, outside of Spark's memory; no page is ever a row.
    """

    def cut(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for file, order, path, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = None
                if length >= large:
                    store, at = in_task(path)
                    with store.open_input_stream(at) as stream:
                        data = stream.read()
                    try:
                        text = data.decode()
                        ends = cuts(text, size)
                    except UnicodeDecodeError:
                        ends = None  # replaced bytes have other lengths
                    del data
                if ends is None:
                    rows.append((file, order, path, 0, True, 0, length))
                    continue
                start = len(text[: ends[0]].encode())
                for k, (i, j) in enumerate(zip(ends, [*ends[1:], len(text)])):
                    end = start + len(text[i:j].encode())
                    rows.append((file, order, path, k, False, start, end))
                    start = end
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "file_ord", "path", "block", "whole", "start", "end"])

    found = staged(page_list(spark, folder, False).withColumn("file", T.basename(F.col("path"))), "pages")
    ordered = with_order(found).select("file", F.col("file_ord").cast("long"), "path", "length")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return staged(ordered.repartition(n).mapInArrow(cut, "file string, file_ord long, path string, block int, whole boolean, start long, end long"), "parts").repartition(n)


def read_messages(spark: SparkSession, folder: str, mode: str = "shape", large: int = LARGE, size: int = BLOCK) -> DataFrame:
    """:func:`parse_messages` of the pages of a folder, which tasks read in parts."""
    parse = parser(mode)

    def run(batches):
        def parts():
            for batch in batches:
                for file, order, path, block, whole, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    store, at = in_task(path)
                    with store.open_input_file(at) as data:
                        yield file, order, block, whole, data.read_at(end - start, start).decode("utf-8", "replace")

        return (parse([part]) for part in parts())

    return page_parts(spark, folder, large, size).mapInArrow(run, MESSAGE_SCHEMA).withColumn("ts_key", T.time_key(F.col("ts_text")))


#: Characters of a page that are searched for ids together, and the most that an id's match may take.
SEARCHED, MATCHED = 1 << 20, 256


def read_candidates(spark: SparkSession, folder: str, newest: int = 10, oldest: int = 5) -> DataFrame:
    """(file, pos, guid) of the group pages of a folder: their ten last message ids in reverse, then the five first; pages are searched as
    streams."""

    def run(batches):
        from collections import deque

        import pyarrow as pa

        pattern = re.compile(T.MESSAGE_GUID.encode())
        for batch in batches:
            rows = []
            for file, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, last, rest = [], deque(maxlen=newest), b""
                store, at = in_task(path)
                with store.open_input_stream(at) as data:
                    while True:
                        block = data.read(SEARCHED)
                        text, done = rest + block, 0
                        for m in pattern.finditer(text):
                            if block and m.end() > len(text) - MATCHED:
                                break  # it may go on in the next block
                            done = m.end()
                            last.append(m[1].decode())
                            if len(first) < oldest:
                                first.append(m[1].decode())
                        if not block:
                            break
                        rest = text[max(done, len(text) - 2 * MATCHED) :]
                rows += [(file, pos, guid) for pos, guid in enumerate([*reversed(last), *first])]
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string()))], names=["file", "pos", "guid"])

    pages = page_list(spark, folder, False).withColumn("file", T.basename(F.col("path"))).filter(T.is_group_filename(F.col("file")))
    return pages.select("file", "path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(run, "file string, pos int, guid string")


def containers(tree: Tree, whole: bool = True) -> list[tuple[Node, str]]:
    """Message elements found by shape: (element, id).

    An id in an attribute marks its element, one in a comment the parent; only if there is neither in the whole page, elements
    whose one text holds an id.  Each climbs as long as its parent holds that single id and no other.
    """
    found: list[tuple[Node, str]] = []
    for n in tree.root.find(lambda n: True):
        for value in n.attrs.values():
            m = GUID.search(value or "")
            if m:
                found.append((n, m[0]))
                break
    span = lambda n: tree.source[n.start : n.end]
    for n in tree.comments:
        m = GUID.search(span(n))
        if n is not tree.root and m:
            found.append((n, m[0]))
    if not found and whole:
        for n in tree.root.find(lambda n: len(n.children) == 1 and isinstance(n.children[0], str)):
            m = GUID.search(n.children[0])
            if m:
                found.append((n, m[0]))
    # Ids by position, so that each climbing step looks at its parent's own range only.
    at = [(m.start(), m[0]) for m in GUID.finditer(tree.source)]
    from bisect import bisect_left

    starts = [s for s, _ in at]

    def only(n: Node, guid: str) -> bool:
        lo, hi = bisect_left(starts, n.start), bisect_left(starts, n.end)
        return lo < hi and all(g == guid for _, g in at[lo:hi])

    out, seen = [], set()
    for n, guid in found:
        while n.parent is not None and n.parent is not tree.root and n.parent.tag not in ("body", "html") and only(n.parent, guid):
            n = n.parent
        if id(n) not in seen:
            seen.add(id(n))
            out.append((n, guid))
    return sorted(out, key=lambda x: x[0].order)


def message_divs(tree: Tree) -> list[tuple[Node, str]]:
    """One element for each div.message; its id follows message-guid=."""
    pattern = re.compile(T.MESSAGE_GUID)
    out = []
    for n in tree.root.find(lambda n: n.tag == "div" and n.has_class("message")):
        m = pattern.search(tree.source[n.start : n.end])
        if m:
            out.append((n, m[1]))
    return out


def shown_time(node: Node) -> str:
    """span.timestamp, else time[datetime], else the element's text."""
    for n in node.find(lambda n: n.tag == "span" and n.has_class("timestamp")):
        return " ".join(n.text().split())
    for n in node.find(lambda n: n.tag == "time" and n.attrs.get("datetime")):
        return n.attrs["datetime"]
    return " ".join(node.text().split())


def parse_messages(pages: DataFrame, mode: str = "shape", large: int = LARGE, size: int = BLOCK) -> DataFrame:
    """(file, file_ord, msg_ord, guid, ts_text, ts_key, html) of pages (file, file_ord, text).

    ``shape`` finds containers by their ids and splits a message that also holds another id; ``div`` gives one
    row for each message element.  Large pages are cut by a scan and parsed by several tasks; their ``msg_ord`` has gaps between
    the parts.
    """
    parse = parser(mode)

    def run(batches):
        for batch in batches:
            yield parse(zip(*(c.to_pylist() for c in batch.columns), strict=True))

    small = pages.filter(F.coalesce(F.length("text"), F.lit(0)) < large)
    parts = small.select("file", F.col("file_ord").cast("long").alias("file_ord"), F.lit(0).alias("block"), F.lit(True).alias("whole"), "text").union(blocks(pages, large, size))
    return parts.mapInArrow(run, MESSAGE_SCHEMA).withColumn("ts_key", T.time_key(F.col("ts_text")))


def parser(mode: str):
    """Makes one batch of messages of parts (file, file_ord, block, whole, text)."""
    if mode not in ("shape", "div"):
        raise ValueError(mode)

    def parse(parts):
        import pyarrow as pa

        rows = []
        for file, order, block, whole, text in parts:
            tree = Tree(text or "")
            for k, (n, guid) in enumerate(containers(tree, whole) if mode == "shape" else message_divs(tree)):
                rows.append((file, order, block * PLACES + k, guid.upper(), shown_time(n), tree.source[n.start : n.end]))
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "file_ord", "msg_ord", "guid", "ts_text", "html"])

    return parse


def shells(pages: DataFrame) -> DataFrame:
    """(file, before, after): what stands around the messages of each page (file, text), with the place for messages
    at the end of its body."""

    def cut(text: str) -> tuple[str, str]:
        tree = Tree(text)
        kept, at = [], 0
        for start, end in sorted((n.start, n.end) for n, _ in containers(tree)):
            if start >= at:
                kept.append(text[at:start])
                at = end
        rest = "".join([*kept, text[at:]])
        place = rest.lower().rfind("</body")
        return (rest, "") if place < 0 else (rest[:place], rest[place:])

    def parse(batches):
        import pyarrow as pa

        for batch in batches:
            parts = [cut(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b for b, _ in parts], pa.string()), pa.array([a for _, a in parts], pa.string())], names=["file", "before", "after"])

    return pages.select("file", "text").mapInArrow(parse, "file string, before string, after string")


def _tel(node: Node) -> str | None:
    for n in node.find(lambda n: n.tag == "a" and n.has_class("tel")):
        href = n.attrs.get("href") or ""
        if href.startswith("tel:"):
            return href[4:] or None
    return None


def parse_chunk(text: str) -> tuple[str, list[str], str | None, list[dict]]:
    """(title, participants, own number, messages) of one voice conversation file."""
    from datetime import datetime

    tree = Tree(text)
    title = next((n.text().strip() for n in tree.root.find(lambda n: n.tag == "title")), "")
    people = []
    for box in tree.root.find(lambda n: n.has_class("participants")):
        people += [t for t in (_tel(c) for c in box.find(lambda n: n.tag == "cite")) if t]
    own, messages = None, []
    for node in tree.root.find(lambda n: n.tag == "div" and n.has_class("message")):
        stamp = next((n.attrs["title"] for n in node.find(lambda n: n.tag == "abbr" and n.has_class("dt") and n.attrs.get("title"))), None)
        try:
            iso = datetime.fromisoformat(stamp).isoformat() if stamp else None
        except ValueError:
            iso = None
        if iso is None:
            continue
        sender = next(node.find(lambda n: n.tag == "cite" and n.has_class("sender")), None)
        tel = _tel(sender) if sender else None
        name = next((n.text().strip() for n in sender.find(lambda n: n.has_class("fn"))), "") if sender else ""
        is_me = name == "Me"
        if is_me and tel:
            own = tel
        quote = next(node.find(lambda n: n.tag == "q"), None)
        body = tree.source[quote.start : quote.end] if quote else ""
        body = re.sub(r"^<[^>]*>|</q\s*>$", "", body)
        images = [n.attrs["src"] for n in node.find(lambda n: n.tag == "img" and n.attrs.get("src"))]
        messages.append({"ts_iso": iso, "sender_tel": tel, "sender_text": name, "is_me": is_me, "display_name": None, "text_html": body, "attachments": images})
    return title, people, own, messages


def parse_chunks(pages: DataFrame) -> DataFrame:
    """Voice conversation files as chunks, see ``CHUNK_SCHEMA``; messages without a valid time are dropped."""

    def parse(batches):
        import pyarrow as pa

        message = pa.struct([("ts_iso", pa.string()), ("sender_tel", pa.string()), ("sender_text", pa.string()), ("is_me", pa.bool_()), ("display_name", pa.string()), ("text_html", pa.string()), ("attachments", pa.list_(pa.string()))])
        kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.list_(message)]
        for batch in batches:
            rows = [(f, o, *parse_chunk(t or "")) for f, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "file_ord", "label", "participants", "own_number", "messages"])

    rows = pages.select("file", F.col("file_ord").cast("long"), "text").mapInArrow(parse, CHUNK_SCHEMA)
    named = F.transform("messages", lambda m: m.withField("display_name", T.sender_display(m["sender_text"], m["sender_tel"])))
    return rows.withColumn("label", T.title_label(F.col("label"))).withColumn("messages", named)


def inspect(messages: DataFrame) -> DataFrame:
    """Per file: messages, distinct ids, how many have a time, and an excerpt of the first."""
    return messages.groupBy("file").agg(F.count("*").alias("n"), F.count_distinct("guid").alias("n_ids"), F.count_if(F.col("ts_key") != "").alias("n_dated"), T.excerpt(F.min_by("html", "msg_ord")).alias("sample"))
