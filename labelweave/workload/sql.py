"""SQL fragments the oracle queries are put together from."""

from labelweave import fixed

ADDR = """addr as (
  select c.c_custkey as key, cast(c.c_custkey as varchar) as house_number, p.p_name as road,
         case when c.c_custkey % 3 = 0 then c.c_mktsegment end as unit, n.n_name as city,
         case when c.c_custkey % 4 <> 0 then r.r_name end as state,
         lpad(cast(c.c_custkey as varchar), 5, '0') as postcode
  from customer c join nation n on c.c_nationkey = n.n_nationkey
       join region r on n.n_regionkey = r.r_regionkey
       left join part p on p.p_partkey = c.c_custkey)"""

COLUMNS = ("house_number", "road", "unit", "city", "state", "postcode")


def quote(text):
    return "'" + text.replace("'", "''") + "'"


def listed(values):
    return "[" + ", ".join(quote(v) for v in values) + "]"


def draw(key, purpose, step="0", seed=0):
    text = f"concat_ws('|', cast({key} as varchar), '{purpose}#{seed}', cast({step} as varchar))"
    return f"(('0x' || substr(md5({text}), 1, 8))::ubigint / 4294967296.0)"


FIELDS = "fields as (" + " union all ".join(
    f"select key, '{c}' as label, {c} as value from addr where {c} is not null"
    for c in COLUMNS) + ")"

TEMPLATE0 = f"""ordered as (
  select key, ord, label from (select key from addr),
    (select unnest({listed(fixed.STANDARD_ORDERS[0])}) as label,
            unnest(range(1, 13)) as ord))"""

# Parts in order; needs addr, fields and ordered(key, ord, label).
PARTS = """parts as (
  select o.key, o.ord, o.label, f.value from ordered o
  join fields f on f.key = o.key and f.label = o.label)"""

# One row per token; needs parts.
TOKENS = """words as (
  select key, ord, label, unnest(w) as token, unnest(range(1, len(w) + 1)) as idx
  from (select key, ord, label,
               list_filter(regexp_split_to_array(value, '[ _]'), lambda x: x <> '') as w
        from parts)),
tokens as (
  select key, row_number() over (partition by key order by ord, idx) - 1 as pos, token,
         case when idx = 1 then 'B-' else 'I-' end || label as tag
  from words)"""

OFFSETS = """offsets as (
  select key, pos, token, tag,
         cast(coalesce(sum(length(token) + 1) over (partition by key order by pos
              rows between unbounded preceding and 1 preceding), 0) as bigint) as "begin"
  from tokens)"""


def labelled(*extra, order=TEMPLATE0):
    """The usual chain up to one row per token, with more parts behind."""
    return "with recursive " + ",\n".join([ADDR, FIELDS, order, PARTS, TOKENS, *extra]) + "\n"


PREDICTED = f"""predicted as (
  select key, pos, token, tag as target,
         case when {draw('key', 'err', 'pos')} < 0.1 then 'O' else tag end as prediction
  from tokens)"""


# --- disturbed orders -------------------------------------------------------

def hits(key, purpose, probability, limit, seed=0):
    branches = " ".join(
        f"when {draw(key, purpose, str(step), seed)} >= {probability} then {step - 1}"
        for step in range(1, limit + 1))
    return f"(case {branches} else {limit} end)"


def picked(profile="standard", source="addr", seed=0):
    orders = fixed.ORDERS[profile]
    choice = f"cast(floor({draw('key', 'template', seed=seed)} * {len(orders)}) as integer)"
    branches = " ".join(f"when {i} then {listed(order)}" for i, order in enumerate(orders))
    return f"picked as (select key, case {choice} {branches} end as o from {source})"


def shuffled(probability, source="picked", seed=0):
    ranked = f"{draw('key', 'permute', 'i', seed)}"
    return f"""permuted as (
  select key, list(label order by {ranked}, i) as o
  from (select key, unnest(o) as label, unnest(range(0, len(o))) as i from {source})
  group by key),
shuffled as (
  select p.key, case when {draw('p.key', 'shuffle', seed=seed)} < {probability}
                     then q.o else p.o end as o
  from {source} p join permuted q on p.key = q.key)"""


def duplicated(probability, source="shuffled", room=8, seed=0):
    at = f"cast(floor({draw('key', 'duplicate_to', 'step', seed)} * (len(o) + 1)) as integer)"
    src = f"cast(floor({draw('key', 'duplicate_from', 'step', seed)} * len(o)) as integer)"
    return f"""growing as (
  select key, o, 1 as step,
         least({hits('key', 'duplicate', probability, room, seed)}, 20 - len(o)) as n
  from {source}
  union all
  select key, list_concat(o[1:{at}], [o[{src} + 1]], o[{at} + 1:]), step + 1, n
  from growing where step <= n),
duplicated as (select key, o from growing where step = n + 1 or (n < 1 and step = 1))"""


def shortened(probability, source="duplicated", seed=0):
    at = f"cast(floor({draw('key', 'delete_at', 'step', seed)} * len(o)) as integer)"
    return f"""cutting as (
  select key, o, 1 as step,
         least({hits('key', 'delete', probability, 19, seed)}, len(o) - 1) as n
  from {source}
  union all
  select key, list_concat(o[1:{at}], o[{at} + 2:]), step + 1, n
  from cutting where step <= n),
shortened as (select key, o from cutting where step = n + 1 or (n < 1 and step = 1))"""


def as_ordered(source):
    return (f"ordered as (select key, unnest(o) as label, unnest(range(0, len(o))) as ord "
            f"from {source})")


def order_rows(*parts, source):
    """Oracle for an order query: one row per entry of the order."""
    return ("with recursive " + ",\n".join([ADDR, *parts]) +
            f"\nselect key, cast(unnest(range(0, len(o))) as bigint) as pos, "
            f"unnest(o) as label from {source}")


# --- cleaned messages ---------------------------------------------------------

def cleaned(text):
    e = f"regexp_replace({text}, {quote(fixed.HANDLE_OR_URL)}, '', 'g')"
    e = f"lower(regexp_replace({e}, {quote(fixed.WWW)}, '', 'g'))"
    for short, full in fixed.NEGATIONS.items():
        e = f"regexp_replace({e}, {quote(chr(92) + 'b' + short + chr(92) + 'b')}, {quote(full)}, 'g')"
    return f"trim(regexp_replace({e}, {quote(fixed.NOT_LETTER_OR_BLANK)}, '', 'g'))"


MESSAGES = """messages as (
  select doc_id, concat('@user', doc_id, ' Can''t and WON''T ', text, ' https://t.example/',
                        doc_id, ' www.example.com/', doc_id, ' It''s not') as text
  from documents)"""

DOCUMENT_WORDS = f"""docwords as materialized (
  select doc_id, regexp_split_to_array(lower({cleaned('text')}), '\\s') as w from documents)"""


def gram_rows(source="docwords", key="doc_id"):
    """One row per n-gram, n from 1 to 3; needs ``source`` with a word list w."""
    rows = " union all ".join(
        f"select {key}, {n} as n, unnest(list_transform(range(1, len(w) - {n - 2}), "
        f"lambda i: array_to_string(w[i:i + {n - 1}], ' '))) as term, "
        f"unnest(range(0, len(w) - {n - 1})) as pos from {source} where len(w) >= {n}"
        for n in (1, 2, 3))
    return f"grams as ({rows})"
