"""The order in which the labels of an address are written, and its disturbance.

``order``, ``key``, ``fields`` and ``pairs`` are SQL text, as a rule column names.
They also stand inside lambdas, whose own names therefore end in an underscore.
"""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions.binding import let
from labelweave.functions.draws import hits_text, pick_text, uniform_text


def _list_text(labels):
    return "array(" + ", ".join(f"'{label}'" for label in labels) + ")"


def template(key, profile="standard", seed=0):
    """One of the orders of a profile, each equally likely."""
    orders = fixed.ORDERS[profile]
    choices = ", ".join(_list_text(order) for order in orders)
    return F.expr(f"get(array({choices}), {pick_text(key, 'template', len(orders), seed=seed)})")


def fixed_template(number=0, profile="standard"):
    return F.expr(_list_text(fixed.ORDERS[profile][number]))


def shuffled(order, key, probability, seed=0):
    """The whole order permuted, with the given probability."""
    if probability <= 0:
        return F.col(order)
    ranked = (f"transform({order}, (label_, i_) -> struct("
              f"{uniform_text(key, 'permute', 'i_', seed)} as rank, i_ as place, "
              "label_ as label))")
    return F.expr(f"if({uniform_text(key, 'shuffle', seed=seed)} < {probability}D, "
                  f"array_sort({ranked}).label, {order})")


def duplications(order, key, probability, profile="standard", seed=0):
    """How many labels are to be copied: draws keep hitting and there is room."""
    room = fixed.MAX_ORDER_SIZE - min(len(o) for o in fixed.ORDERS[profile])
    if probability <= 0 or room <= 0:
        return F.lit(0)
    wanted = hits_text(key, "duplicate", probability, room, seed)
    return F.expr(f"least({wanted}, {fixed.MAX_ORDER_SIZE} - size({order}))")


def duplicated(order, key, count, seed=0):
    """Copies of random entries put at random places, ``count`` of them."""
    source = pick_text(key, "duplicate_from", "size(list_)", "step_", seed)
    target = pick_text(key, "duplicate_to", "size(list_) + 1", "step_", seed)
    grown = (f"aggregate(sequence(1, {count}), {order}, (list_, step_) -> "
             f"array_insert(list_, {target} + 1, get(list_, {source})))")
    return F.expr(f"if({count} > 0, {grown}, {order})")


def deletions(order, key, probability, seed=0):
    """How many labels are to be dropped: draws keep hitting and one is left."""
    if probability <= 0:
        return F.lit(0)
    wanted = hits_text(key, "delete", probability, fixed.MAX_ORDER_SIZE - 1, seed)
    return F.expr(f"least({wanted}, size({order}) - 1)")


def shortened(order, key, count, seed=0):
    """Random entries dropped, ``count`` of them."""
    at = pick_text(key, "delete_at", "size(list_)", "step_", seed)
    kept = let("at_", at, "concat(slice(list_, 1, at_), slice(list_, at_ + 2, size(list_)))")
    cut = f"aggregate(sequence(1, {count}), {order}, (list_, step_) -> {kept})"
    return F.expr(f"if({count} > 0, {cut}, {order})")


def present(order, fields):
    """The labels of an order that the record has."""
    return F.expr(let("f_", fields,
                      f"filter({order}, label_ -> map_contains_key(f_, label_))"))


def parts(order, fields):
    """The (label, value) parts of a record in the given order, absent ones left out."""
    found = (f"transform(filter({order}, label_ -> map_contains_key(f_, label_)), "
             "label_ -> struct(label_ as label, f_[label_] as value))")
    return F.expr(let("f_", fields, found))


def first_matches(order, pairs):
    """Per label of the order the first pair of that label, any letter case.

    Pairs whose label is not in the order are left out.
    """
    found = "get(filter(p_, pair_ -> lower(pair_.label) = label_), 0)"
    listed = f"transform({order}, label_ -> {found})"
    return F.expr(let("p_", pairs, f"filter({listed}, pair_ -> pair_ is not null)"))
