"""Preference formatting: one prompt, two masked completions.

A preferred and a rejected conversation usually begin alike. The longest common
prefix of turns is rendered once as the prompt; what follows on either side is
rendered as a completion with a mask of the characters that carry loss.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.llm.common import table
from labelweave.session import materialise

# The template, a parameter of format_preferences.
OPEN, CLOSE = "<|", "|>"
END = "<|end|>\n"
ASSISTANT = "assistant"


def conversations_of(turns):
    """conv_id and its turns, array of (turn, role, text) in order.

    Ties of ``turn`` follow role and text, null first; repeated rows stay
    repeated turns. Rows without conv_id belong to no conversation. A
    conversation becomes one row, as it is one example; whatever is compared
    between conversations is joined by key.
    """
    return (turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))


def next_replies(replies):
    """conv_id and ``other``, the reply of the next conversation in the order of
    numbers; after the last comes the first. A single one is its own next.

    Numbers are range-partitioned and looked up within each partition; the last
    of a partition takes the first of the next, of which there are as many rows
    as partitions.
    """
    runs = materialise(replies.repartitionByRange("conv_id").withColumn("run", F.spark_partition_id()), "replies")
    ahead = F.lead(F.struct("reply")).over(Window.partitionBy("run").orderBy("conv_id"))
    round_ = Window.orderBy("run")
    everything = round_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = runs.groupBy("run").agg(F.min_by(F.struct("reply"), "conv_id").alias("first"))
    firsts = firsts.select("run", F.coalesce(F.lead("first").over(round_), F.first("first").over(everything)).alias("first"))
    return (runs.withColumn("ahead", ahead).join(firsts, "run")
            .select("conv_id", F.coalesce("ahead", "first").reply.alias("other")))


def swapped_reply_pairs(turns):
    """pair_id, chosen, rejected: a conversation, and the same one answered with
    the last reply of the next conversation that has one, in the order of numbers,
    going round. Every conversation with a reply forms a pair."""
    speech = F.transform("turns", lambda t: F.struct(t.role, t.text))
    replies = F.filter("turns", lambda t: t.role == ASSISTANT)
    convs = (conversations_of(turns)
             .withColumn("reply", F.try_element_at(F.transform(replies, lambda t: t.text), F.lit(-1)))
             .where(F.size(replies) > 0)
             .select("conv_id", speech.alias("chosen"), "reply"))
    last = F.size("chosen") - F.array_position(
        F.reverse(F.transform("chosen", lambda t: F.coalesce(t.role == ASSISTANT, F.lit(False)))), True)
    return (convs.drop("reply").join(next_replies(convs.select("conv_id", "reply")), "conv_id")
            .withColumn("last", last.cast("int"))
            .select(F.col("conv_id").alias("pair_id"), "chosen",
                    F.concat(F.slice("chosen", F.lit(1), F.col("last")),
                             F.array(F.struct(F.lit(ASSISTANT).alias("role"), F.col("other").alias("text"))))
                    .alias("rejected")))


def _clean(text):
    """Text that cannot be read as a marker of the template; null is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |"))


def _head(turn):
    return F.concat(F.lit(OPEN), _clean(turn.role), F.lit(CLOSE + "\n"))


def render(turns):
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _clean(t.text), F.lit(END))), "")


def loss_mask(turns, role=ASSISTANT):
    """'1' for every character of a reply and its end marker, '0' elsewhere."""
    def of(t):
        body = F.length(_clean(t.text)) + len(END)
        return F.concat(F.repeat(F.lit("0"), F.length(_head(t))),
                        F.repeat(F.when(t.role == role, "1").otherwise("0"), body))
    return F.array_join(F.transform(turns, of), "")


def format_preferences(pairs):
    """prompt_turns, prompt, and for either side the completion and its mask.

    ``chosen`` and ``rejected`` are arrays of (role, text), replaced by the
    rendered completions; other columns stay. Turns are common if role and text
    are, null like null. A null side is an empty conversation. Without a common
    first turn the prompt is empty; of equal sides both completions are.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.withColumns({s: F.coalesce(F.col(s), empty) for s in ("chosen", "rejected")})
    same = F.zip_with("chosen", "rejected", lambda a, b: a.isNotNull() & b.isNotNull()
                      & a.role.eqNullSafe(b.role) & a.text.eqNullSafe(b.text))
    differ = F.array_position(same, False)
    split = sides.withColumn("prompt_turns", F.when(differ == 0, F.size("chosen"))
                             .otherwise(differ - 1).cast("int"))
    rest = lambda s: F.slice(s, F.col("prompt_turns") + 1, F.size(s))
    return split.withColumns({
        "prompt": render(F.slice("chosen", F.lit(1), F.col("prompt_turns"))),
        "chosen_mask": loss_mask(rest("chosen")), "rejected_mask": loss_mask(rest("rejected")),
        "chosen": render(rest("chosen")), "rejected": render(rest("rejected"))})


def op3_preference_formatting(spark, sf_dir):
    return format_preferences(swapped_reply_pairs(table(spark, sf_dir, "conversations")))


ORACLE = """
with t as (
  select conv_id, role, text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as i
  from conversations where conv_id is not null),
reply as (
  select conv_id, i as last, text as reply from t where role = 'assistant'
  qualify row_number() over (partition by conv_id order by i desc) = 1),
pair as (
  select conv_id as pair_id, last, case when conv_id = max(conv_id) over () then first(reply) over (order by conv_id)
         else lead(reply) over (order by conv_id) end as other
  from reply),
chosen as (select pair_id, i, role, text from t join pair on pair_id = conv_id),
rejected as (
  select pair_id, i, role, text from t join pair on pair_id = conv_id where i < last
  union all select pair_id, last, 'assistant', other from pair),
cut as (
  select pair_id, min(i) as first_other
  from (select coalesce(c.pair_id, r.pair_id) as pair_id, coalesce(c.i, r.i) as i
        from chosen c full join rejected r on c.pair_id = r.pair_id and c.i = r.i
        where c.i is null or r.i is null or c.role is distinct from r.role or c.text is distinct from r.text)
  group by pair_id),
shown as (
  select *, '<|' || replace(coalesce(role, ''), '<|', '< |') || '|>' || chr(10) as head,
         replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) as body
  from (select 'c' as side, * from chosen union all select 'r', * from rejected)),
sized as (
  select p.pair_id, coalesce(first_other, (select count(*) from chosen c where c.pair_id = p.pair_id)) as n
  from pair p left join cut using (pair_id))
select z.pair_id, cast(any_value(n) as int) as prompt_turns,
  coalesce(string_agg(head || body, '' order by i) filter (side = 'c' and i < n), '') as prompt,
  coalesce(string_agg(head || body, '' order by i) filter (side = 'c' and i >= n), '') as chosen,
  coalesce(string_agg(head || body, '' order by i) filter (side = 'r' and i >= n), '') as rejected,
  coalesce(string_agg(repeat('0', length(head)) || repeat(case when role = 'assistant' then '1' else '0' end,
    length(body)), '' order by i) filter (side = 'c' and i >= n), '') as chosen_mask,
  coalesce(string_agg(repeat('0', length(head)) || repeat(case when role = 'assistant' then '1' else '0' end,
    length(body)), '' order by i) filter (side = 'r' and i >= n), '') as rejected_mask
from shown s join sized z on s.pair_id = z.pair_id group by z.pair_id
"""
