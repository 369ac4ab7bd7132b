"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.llm.decontaminate import contaminated
from wagewright.llm.line_dedup import drop_shared_lines
from wagewright.llm.near_dedup import near_duplicates
from wagewright.llm.packing import pack
from wagewright.llm.page_text import main_text
from wagewright.llm.perspectives import dialogues, perspectives
from wagewright.llm.phrases import collocations
from wagewright.llm.pii import personal_data
from wagewright.llm.prefix_trie import numbered, prefix_trie, with_heads
from wagewright.llm.quality_rules import RULES, STOP_WORDS, quality_rules
from wagewright.llm.substring import repeated_passages, without_passages
from wagewright.llm.subwords import quality
from wagewright.llm.toxicity import toxicity
from wagewright.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


SPACE = r"[\x20\x09-\x0D]"


def _rule_sql(rule) -> str:
    up = f"100 * {rule.numerator}"
    sides = [f"{up} < {rule.low} * {rule.denominator}"] * (rule.low is not None) + [f"{up} > {rule.high} * {rule.denominator}"] * (rule.high is not None)
    return " OR ".join(sides)


OP3 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(string_split_regex(t, '{SPACE}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{SPACE}+', '', 'g') <> '') AS l FROM d),
p AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM p QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
c AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{SPACE}+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
             len(list_filter(l, lambda x: NOT regexp_matches(rtrim(x, ' '), '[.!?…]$'))) AS n_open_lines,
             len(list_filter(w, lambda x: lower(x) IN ({', '.join(f"'{s}'" for s in dict.fromkeys(STOP_WORDS))}))) AS n_stop,
             length(t) - length(replace(t, '!', '')) AS n_marks
      FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             concat_ws(',', {', '.join(f"CASE WHEN {_rule_sql(r)} THEN '{r.name}' END" for r in RULES)}) AS failed_rules FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules,
       n_lines::BIGINT AS n_lines, n_open_lines::BIGINT AS n_open_lines, n_stop::BIGINT AS n_stop, n_marks::BIGINT AS n_marks FROM f
"""


@query("op3_quality_rules", OP3)
def op3(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


OP4 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, doc_id, i, x[i] AS line, translate(regexp_replace(regexp_replace(x[i], '^{SPACE}+', ''), '{SPACE}+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT r, doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT r, doc_id, string_split(t, chr(10)) AS x FROM d))),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, f.k IS NOT NULL AND doc_id <> last AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


@query("op4_line_dedup", OP4)
def op4(spark, sf_dir):
    out = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d WHERE len(w) > 1)
      UNION ALL SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.to_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS c FROM reach GROUP BY doc_id) USING (doc_id)
"""


@query("op6_minhash_near_dedup", OP6)
def op6(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


OP8 = """
WITH t AS (SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS content FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (SELECT conv_id, perspective, turn, content, coalesce(speaker = perspective, false) AS mine, speaker FROM t JOIN p ON conv_id IS NOT DISTINCT FROM c),
r AS (SELECT conv_id, perspective, turn, CASE WHEN mine THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
             CASE WHEN NOT mine AND coalesce(speaker, '') <> 'system' THEN coalesce(speaker, 'unknown') END AS name, content, mine AND content <> '' AS train FROM s),
h AS (SELECT *, '<|' || role || CASE WHEN name IS NULL THEN '' ELSE ':' || name END || '|>' || chr(10) AS head FROM r)
SELECT conv_id, perspective, turn, role, name, content, train, head || content || '<|end|>' || chr(10) AS rendered,
       length(head)::BIGINT AS train_from, (length(head) + CASE WHEN train THEN length(content) + 7 ELSE 0 END)::BIGINT AS train_to FROM h
"""


@query("op8_perspective_rotation", OP8)
def op8(spark, sf_dir):
    return perspectives(table(spark, sf_dir, "conversations"))


@query("op8_dialogues")
def op8_dialogues(spark, sf_dir):
    return dialogues(table(spark, sf_dir, "conversations"))


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op1_without_passages")
def op1_without_passages(spark, sf_dir):
    """The documents as the removal leaves them, with the original offsets of what went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = without_passages(docs, repeated_passages(docs))
    return left.select("doc_id", "removed", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_packing")
def op5(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@query("op7_html_extraction")
def op7(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


@query("op9_pii")
def op9(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


@query("op10_decontamination")
def op10(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 of a byte list, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295, {bytes}), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
               lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

OP12 = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, max(pos) AS own, conv_id - conv_id % 20 AS base,
             {CRC32.format(bytes="list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} % 4 AS h FROM t GROUP BY conv_id),
i AS (SELECT n.*, least(n.h, coalesce(b.own, 0)) AS taken FROM n LEFT JOIN n b ON b.conv_id = n.base),
r AS (SELECT i.conv_id AS c, pos AS d, role, text FROM i JOIN t ON t.conv_id = i.base AND t.pos <= i.taken
      UNION ALL SELECT i.conv_id, pos - h + taken, role, text FROM i JOIN t USING (conv_id) WHERE pos > h),
p AS (SELECT c, d, text, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS k FROM r
      UNION ALL SELECT conv_id, 0, '', '' FROM i),
l AS (SELECT c, max(d) AS last FROM p GROUP BY c),
e AS (SELECT p.d, p.k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM p JOIN l USING (c) WHERE d = last GROUP BY ALL),
v AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * len(list_filter(string_split_regex(any_value(text), '{SPACE}+'), lambda x: x <> '')) AS cost FROM p GROUP BY d, k),
a AS (SELECT v.*, u.conv_id AS parent_conv_id, u.k AS up FROM v LEFT JOIN v u ON u.d = v.d - 1 AND u.k = left(v.k, greatest(length(v.k) - 32, 0))),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM a WHERE d > 0 GROUP BY ALL),
sub AS (SELECT x.d, x.k, sum(y.cost) AS saved, count_if(q.k IS NULL) AS leaves
        FROM (SELECT DISTINCT x.d, x.k, y.d AS yd, y.k AS yk FROM p x JOIN p y ON x.c = y.c AND y.d >= x.d) x
        JOIN v y ON y.d = x.yd AND y.k = x.yk LEFT JOIN kids q ON q.d = x.yd AND q.k = x.yk GROUP BY x.d, x.k)
SELECT a.conv_id, a.d::BIGINT AS depth, a.parent_conv_id, a.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM a JOIN sub ON sub.d = a.d AND sub.k = a.k LEFT JOIN kids ON kids.d = a.d AND kids.k = a.k LEFT JOIN e ON e.d = a.d AND e.k = a.k
"""


@query("op12_prefix_trie", OP12)
def op12(spark, sf_dir):
    return prefix_trie(*with_heads(numbered(table(spark, sf_dir, "conversations"))))


OP11 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
                  string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS x FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda y: y <> '') AS w FROM (SELECT lang, unnest(x) AS piece FROM p)),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w)
      UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
cuts AS (SELECT lang, phrase, k, a, i, array_to_string(w[1:i], ' ') AS x, array_to_string(w[i + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
s AS (SELECT cuts.*, l.c AS l, r.c AS r, (1000000::HUGEINT * a * a // (l.c::HUGEINT * r.c))::BIGINT AS score
      FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""


@query("op11_collocations", OP11)
def op11(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_quality_classifier")
def op13(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
