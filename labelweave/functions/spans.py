"""Tagged tokens back to chunks."""

from pyspark.sql import functions as F

from labelweave.functions.binding import let
from labelweave.functions.labels import running_starts_text

_OPENS = "substring({tag}, 1, 2) = 'B-'"
_CONTINUES = "substring({tag}, 1, 2) = 'I-'"


def _opens_chunk(mode):
    """Whether item ``i`` opens a chunk.

    ``glue`` lets a continuing tag join whatever chunk came last, and drops it
    where none is open. ``strict`` opens a new chunk when the label changes or
    the tag before was outside.
    """
    opened = _OPENS.format(tag="item.tag")
    if mode == "glue":
        return opened
    before = "get(items, i - 1).tag"
    joins = (f"coalesce(({_OPENS.format(tag=before)} or {_CONTINUES.format(tag=before)}) "
             f"and substring({before}, 3) = substring(item.tag, 3), false)")
    return f"({opened} or ({_CONTINUES.format(tag='item.tag')} and not {joins}))"


def chunks(tokens, mode="glue"):
    """``(label, chunk, begin, end)`` of every chunk of an array of (token, tag).

    A chunk takes the slice up to the next start, so the work is linear in the
    number of tokens. ``tokens`` is SQL text, as a rule a column name.
    """
    items = let("starts", running_starts_text("listed.token"),
                "transform(listed, (t, i) -> struct(t.token as token, t.tag as tag, "
                "starts[i] as begin, starts[i] + length(t.token) - 1 as end))")
    firsts = (f"filter(transform(items, (item, i) -> if({_opens_chunk(mode)}, i, null)), "
              "i -> i is not null)")
    inside = f"{_OPENS.format(tag='x.tag')} or {_CONTINUES.format(tag='x.tag')}"
    length = "coalesce(get(firsts, k + 1), size(items)) - first"
    piece = f"filter(slice(items, first + 1, {length}), x -> {inside})"
    chunk = ("struct(substring(items[first].tag, 3) as label, "
             "array_join(piece.token, ' ') as chunk, "
             "items[first].begin as begin, element_at(piece, -1).end as end)")
    found = f"transform(firsts, (first, k) -> {let('piece', piece, chunk)})"
    return F.expr(let("listed", tokens, let("items", items, let("firsts", firsts, found))))


def last_chunk_of(found, label):
    """The last chunk of a label, NULL where there is none."""
    return F.expr(f"try_element_at(filter({found}, c -> c.label = '{label}'), -1).chunk")
