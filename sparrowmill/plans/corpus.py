"""Group J: corpus and sequence preparation."""

from pyspark.sql import functions as F

from sparrowmill.functions import text as tx
from sparrowmill.operators import corpus as op
from sparrowmill.operators import metrics as mx
from sparrowmill.plans.registry import query, rand_sql
from sparrowmill.session import materialize, spread
from sparrowmill.tables import table

WORDS = "list_filter(string_split(lower(regexp_replace({c}, '[^A-Za-z]+', ' ', 'g')), ' '), lambda w_: w_ <> '')"
DOC_WORDS = WORDS.format(c="text")
TOK = (
    f"docw as (select doc_id, lang, source, {DOC_WORDS} as w from documents), "
    "tok as (select doc_id, lang, source, unnest(w) as token, generate_subscripts(w, 1) - 1 as pos from docw)"
)
VOC = (
    TOK + ", cnt as (select token, count(*) as freq from tok group by token), "
    "voc as (select token, freq, row_number() over (order by freq desc, token) as id from cnt)"
)
IDS = VOC + (
    ", coded as (select doc_id, list(id order by pos) as ids, any_value(len) as len from "
    "(select t.doc_id, t.pos, v.id, count(*) over (partition by t.doc_id) as len from tok t join voc v using (token)) group by doc_id)"
)
UNI = TOK + ", uni as (select token, count(*) as n from tok group by token)"
BI = (
    UNI + ", pairs as (select doc_id, lang, source, token as w1, lead(token) over (partition by doc_id order by pos) as w2 from tok), "
    "bi as (select w1, w2, count(*) as n from pairs where w2 is not null group by w1, w2)"
)
MODEL = BI + (
    ", tot as (select sum(n) as t from uni), model as (select b.w1, b.w2, b.n, b.n / a.n as p, "
    "(b.n + 2.0 * (c.n / (select t from tot))) / (a.n + 2.0) as p_smooth "
    "from bi b join uni a on a.token = b.w1 join uni c on c.token = b.w2)"
)
PAIRS = (
    "pairs as (select a.conv_id || '-' || a.turn as pair_id, a.text as source, b.text as target "
    "from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1 "
    "where a.role = 'user' and b.role = 'assistant')"
)


def side_sql(side: str, specials: int, min_freq: int, unk: int) -> str:
    """Common table expressions: words, vocabulary and ids of one side of the turn pairs."""
    words = WORDS.format(c=side)
    s = side
    return (
        f"{s}_w as (select pair_id, {words} as w from pairs), "
        f"{s}_t as (select pair_id, unnest(w) as token, generate_subscripts(w, 1) as pos from {s}_w), "
        f"{s}_v as (select token, {specials - 1} + row_number() over (order by n desc, token) as id from "
        f"(select token, count(*) as n from {s}_t group by token having count(*) >= {min_freq})), "
        f"{s}_c as (select pair_id, list(coalesce(id, {unk}) order by pos) as ids from {s}_t left join {s}_v using (token) group by pair_id), "
        f"{s}_i as (select p.pair_id, coalesce(c.ids, []) as ids from pairs p left join {s}_c c using (pair_id))"
    )


def docs(spark, sf):
    return spread(table(spark, sf, "documents"))


def doc_words():
    return tx.words(F.col("text"))


def doc_vocab(spark, sf):
    return op.build_vocab(docs(spark, sf), doc_words())


def coded_docs(spark, sf):
    return op.encode_rows(docs(spark, sf), doc_words(), doc_vocab(spark, sf), "doc_id").filter(F.size("ids") > 0)


def joined(col):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


def joined_sql(expr):
    return f"array_to_string({expr}, ',')"


@query("J01_chars", """
with c as (select string_split(text, '') as s from documents),
e as (select unnest(s) as token, generate_subscripts(s, 1) - 1 as pos from c)
select token, count(*) as n, cast(sum(pos) as bigint) as pos_sum from e group by token
""")
def j01(spark, sf):
    long = op.explode_tokens(docs(spark, sf), tx.chars(F.col("text")))
    return long.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos_sum"))


@query("J02_words", f"""
select doc_id, cast(len(w) as bigint) as n_words, md5(array_to_string(w, ' ')) as digest
from (select doc_id, {DOC_WORDS} as w from documents)
""")
def j02(spark, sf):
    w = docs(spark, sf).select("doc_id", doc_words().alias("w"))
    return w.select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.md5(F.array_join("w", " ")).alias("digest"))


@query("J03_build_vocab", f"""
with {VOC} select token, cast(id as bigint) as id, freq from voc union all select '<unk>', 0, null
""")
def j03(spark, sf):
    return doc_vocab(spark, sf)


@query("J03_build_vocab_specials", f"""
with {TOK} select token, cast(3 + row_number() over (order by freq desc, token) as bigint) as id, freq
from (select token, count(*) as freq from tok group by token having count(*) >= 3)
union all select unnest(['<pad>', '<bos>', '<eos>', '<unk>']), unnest([0, 1, 2, 3]), null
""")
def j03_specials(spark, sf):
    return op.build_vocab(docs(spark, sf), doc_words(), 3, ("<pad>", "<bos>", "<eos>", "<unk>"))


@query("J04_encode_docs", f"""
with {IDS} select doc_id, cast(len as bigint) as n, md5({joined_sql('ids')}) as digest from coded
""")
def j04(spark, sf):
    coded = coded_docs(spark, sf)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n"), F.md5(joined(F.col("ids"))).alias("digest"))


@query("J05_decode_docs", """
select doc_id, md5(array_to_string(w, ' ')) as digest from (select doc_id, %s as w from documents) where len(w) > 0
""" % DOC_WORDS)
def j05(spark, sf):
    vocab = doc_vocab(spark, sf)
    coded = op.encode_rows(docs(spark, sf), doc_words(), vocab, "doc_id").filter(F.size("ids") > 0)
    back = op.decode_rows(coded, vocab, "doc_id")
    return back.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("J06_unigrams", f"with {UNI} select token as gram, n from uni")
def j06_1(spark, sf):
    return op.ngram_counts(docs(spark, sf), doc_words(), 1)


@query("J06_bigrams", f"with {BI} select w1 || ' ' || w2 as gram, n from bi")
def j06_2(spark, sf):
    return op.ngram_counts(docs(spark, sf), doc_words(), 2)


@query("J06_trigrams", f"""
with {TOK}, tri as (select token || ' ' || lead(token) over (partition by doc_id order by pos) || ' ' ||
 lead(token, 2) over (partition by doc_id order by pos) as gram from tok)
select gram, count(*) as n from tri where gram is not null group by gram
""")
def j06_3(spark, sf):
    return op.ngram_counts(docs(spark, sf), doc_words(), 3)


@query("J07_unigram_prob", f"""
with {UNI}, s as (select sum(n) as t, count(*) as m from uni)
select token as gram, n, round(n / t, 12) as p, round((n + 1.0 / m) / (t + 1.0), 12) as p_smooth from uni, s
""")
def j07(spark, sf):
    p = op.unigram_probabilities(op.ngram_counts(docs(spark, sf), doc_words(), 1), 1.0)
    return p.select("gram", "n", F.round("p", 12).alias("p"), F.round("p_smooth", 12).alias("p_smooth"))


def bigram_model(spark, sf, eps=2.0):
    counts = op.word_pairs(docs(spark, sf), doc_words())
    return op.bigram_probabilities(op.bigrams_of_pairs(counts), op.words_of_pairs(counts), eps)


@query("J08_bigram_prob", f"""
with {MODEL} select w1, w2, n, round(p, 10) as p, round(p_smooth, 10) as p_smooth from model
""")
def j08(spark, sf):
    m = bigram_model(spark, sf)
    return m.select("w1", "w2", "n", F.round("p", 10).alias("p"), F.round("p_smooth", 10).alias("p_smooth"))


_OFF = f"cast(floor({rand_sql('doc_id', seed=11)} * 16) as int)"


@query("J09_windows_random", f"""
with {IDS}, o as (select doc_id, ids, {_OFF} as off, (len - {_OFF} - 1) // 16 - 1 as n from coded),
win as (select doc_id, ids, off, cast(unnest(range(0, cast(n as bigint))) as int) as win from o where n > 0),
cut as (select doc_id, win, off, ids, row_number() over (order by {rand_sql('doc_id', 'win', seed='11w')}, doc_id, win) - 1 as i from win)
select doc_id, win, i // 8 as batch, i % 8 as slot,
 {joined_sql('ids[off + win * 16 + 1 : off + win * 16 + 16]')} as x, {joined_sql('ids[off + win * 16 + 2 : off + win * 16 + 17]')} as y
from cut where i // 8 < (select count(*) // 8 from cut)
""")
def j09(spark, sf):
    w = op.random_windows(coded_docs(spark, sf), "doc_id", 16, 8, 11)
    return w.select("doc_id", "win", "batch", "slot", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


_OFF10 = f"cast(floor({rand_sql('doc_id', seed=12)} * 10) as int)"


@query("J10_windows_consecutive", f"""
with {IDS}, o as (select doc_id, ids, {_OFF10} as off, (len - {_OFF10}) // 4 as wd from coded),
e as (select *, cast((wd - 1) // 10 as bigint) as n from o),
st as (select doc_id, ids, off, wd, cast(unnest(range(0, n)) as int) as step from e where n > 0),
g as (select *, cast(unnest(range(0, 4)) as int) as strip from st),
a as (select *, off + strip * wd + step * 10 as o from g)
select doc_id, step, strip, {joined_sql('ids[o + 1 : o + 10]')} as x, {joined_sql('ids[o + 2 : o + 11]')} as y from a
""")
def j10(spark, sf):
    w = op.strip_windows(coded_docs(spark, sf), "doc_id", 10, 4, 12)
    return w.select("doc_id", "step", "strip", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


# fixed values: the special tokens of a sentence pair, in the order of their ids
SPECIALS = ("<pad>", "<bos>", "<eos>", "<unk>")


def turn_pairs(spark, sf):
    """Stored: vocabularies and encodings read the pairs, not the join again."""
    return materialize(op.turn_pairs(table(spark, sf, "conversations")))


def side_ids(pairs, side, min_freq=3, specials=SPECIALS, unk=3):
    tokens = tx.words(F.col(side))
    vocab = op.build_vocab(pairs, tokens, min_freq, specials)
    return op.encode_rows(pairs, tokens, vocab, "pair_id", unk)


def target_arrays(pairs, max_len=24):
    coded = side_ids(pairs, "target")
    y = coded.select("pair_id", op.padded(F.col("ids"), max_len, 0, 1, 2).alias("y"))
    return y.withColumn("y_len", op.valid_length(F.col("y")))


_PAD24 = "list_resize(([1] || ids || [2])[1:24], 24, 0)"
_PAD24S = "list_resize(ids[1:24], 24, 0)"
_VALID = "cast(len(list_filter({a}, lambda t_: t_ <> 0)) as int)"


@query("J11_build_array", f"""
with {PAIRS}, {side_sql('target', 4, 3, 3)}, a as (select pair_id, {_PAD24} as y from target_i)
select pair_id, {joined_sql('y')} as y, {_VALID.format(a='y')} as y_len from a
""")
def j11(spark, sf):
    return target_arrays(turn_pairs(spark, sf)).withColumn("y", joined(F.col("y")))


@query("J12_nmt_examples", f"""
with {PAIRS}, {side_sql('source', 4, 3, 3)}, {side_sql('target', 4, 3, 3)},
a as (select s.pair_id, list_resize(s.ids[1:24], 24, 0) as x, list_resize(([1] || t.ids || [2])[1:24], 24, 0) as y
 from source_i s join target_i t using (pair_id))
select pair_id, {joined_sql('x')} as x, {_VALID.format(a='x')} as x_len, {joined_sql('y')} as y, {_VALID.format(a='y')} as y_len from a
""")
def j12(spark, sf):
    pairs = turn_pairs(spark, sf)
    x = side_ids(pairs, "source").select("pair_id", op.padded(F.col("ids"), 24).alias("x"))
    x = x.withColumn("x_len", op.valid_length(F.col("x")))
    both = x.join(target_arrays(pairs), "pair_id")
    return both.withColumn("x", joined(F.col("x"))).withColumn("y", joined(F.col("y")))


@query("J13_teacher_shift", f"""
with {PAIRS}, {side_sql('target', 4, 3, 3)}, a as (select pair_id, {_PAD24} as y from target_i)
select pair_id, {joined_sql('y[1:23]')} as y_input, {joined_sql('y[2:24]')} as y_label, {_VALID.format(a='y')} - 1 as y_len from a
""")
def j13(spark, sf):
    y = target_arrays(turn_pairs(spark, sf))
    n = F.size("y") - 1
    return y.select(
        "pair_id",
        joined(F.slice("y", F.lit(1), n)).alias("y_input"),
        joined(F.slice("y", F.lit(2), n)).alias("y_label"),
        (F.col("y_len") - 1).alias("y_len"),
    )


@query("J14_length_hist", f"""
with {PAIRS}, l as (select 'source' as side, len({WORDS.format(c='source')}) as n from pairs
 union all select 'target', len({WORDS.format(c='target')}) from pairs)
select side, cast(least(floor((n - (select min(n) from l)) / (((select max(n) from l) - (select min(n) from l)) / 10.0::double)), 9) as bigint) as bin, count(*) as n from l group by all
""")
def j14(spark, sf):
    p = turn_pairs(spark, sf)
    both = p.select(F.explode(F.array(
        F.struct(F.lit("source").alias("side"), F.size(tx.words(F.col("source"))).alias("n")),
        F.struct(F.lit("target").alias("side"), F.size(tx.words(F.col("target"))).alias("n")),
    )).alias("s")).select("s.side", "s.n")
    return mx.histogram(both, F.col("n"), 10, by=["side"])


# fixed values: the special tokens of a joined pair, in the order of their ids
_PAIR_SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]")


@query("J15_encode_pair", f"""
with {PAIRS}, both_t as (select pair_id, 0 as side, unnest(w) as token, generate_subscripts(w, 1) as pos from (select pair_id, {WORDS.format(c='source')} as w from pairs)
 union all select pair_id, 1, unnest(w), generate_subscripts(w, 1) from (select pair_id, {WORDS.format(c='target')} as w from pairs)),
v as (select token, 3 + row_number() over (order by n desc, token) as id from (select token, count(*) as n from both_t group by token)),
c as (select pair_id, coalesce(list(id order by pos) filter (side = 0), []) as a, coalesce(list(id order by pos) filter (side = 1), []) as b
 from both_t join v using (token) group by pair_id),
k as (select *, case when len(a) + len(b) > 37 then least(len(a), greatest(37 - len(b), 19)) else len(a) end as ka from c),
l as (select *, case when len(a) + len(b) > 37 then 37 - ka else len(b) end as kb from k)
select pair_id, {joined_sql('list_resize([2] || a[1:ka] || [3] || b[1:kb] || [3], 40, 0)')} as input_ids,
 {joined_sql('list_transform(range(0, 40), lambda i: case when i >= ka + 2 and i < ka + kb + 3 then 1 else 0 end)')} as token_type_ids,
 {joined_sql('list_transform(range(0, 40), lambda i: case when i < ka + kb + 3 then 1 else 0 end)')} as attention_mask,
 {joined_sql('list_transform(range(0, 40), lambda i: case when i = 0 or i = ka + 1 or i >= ka + kb + 2 then 1 else 0 end)')} as special_tokens_mask,
 cast(ka + kb + 3 as int) as length from l
""")
def j15(spark, sf):
    pairs = turn_pairs(spark, sf)
    a, b = tx.words(F.col("source")), tx.words(F.col("target"))
    vocab = op.build_vocab(pairs, F.concat(a, b), 1, _PAIR_SPECIALS)
    coded = op.encode_rows(pairs, F.concat(a, b), vocab, "pair_id", 1)
    sized = pairs.select("pair_id", F.size(a).alias("_la"), F.size(b).alias("_lb")).join(coded, "pair_id")
    sized = sized.filter(F.size("ids") > 0)
    left, right = F.slice("ids", F.lit(1), F.col("_la")), F.slice("ids", F.col("_la") + 1, F.col("_lb"))
    out = sized.select("pair_id", left.alias("a"), right.alias("b"))
    cols = op.encode_pair(F.col("a"), F.col("b"), 40, 2, 3)
    return out.select("pair_id", *[(c if n == "length" else joined(c)).alias(n) for n, c in cols.items()])


@query("J15_encode_single", f"""
with s as (select conv_id, turn, {WORDS.format(c='text')} as w from conversations),
t as (select conv_id, turn, unnest(w) as token, generate_subscripts(w, 1) as pos from s),
v as (select token, 3 + row_number() over (order by n desc, token) as id from (select token, count(*) as n from t group by token having count(*) >= 2)),
c as (select conv_id, turn, list(coalesce(id, 1) order by pos) as a from t left join v using (token) group by conv_id, turn),
l as (select s.conv_id, s.turn, coalesce(a, []) as a, least(len(coalesce(a, [])), 18) as n from s left join c using (conv_id, turn))
select conv_id, turn, {joined_sql('list_resize([2] || a[1:n] || [3], 20, 0)')} as input_ids, {joined_sql('list_transform(range(0, 20), lambda i: 0)')} as token_type_ids,
 {joined_sql('list_transform(range(0, 20), lambda i: case when i < n + 2 then 1 else 0 end)')} as attention_mask,
 {joined_sql('list_transform(range(0, 20), lambda i: case when i = 0 or i >= n + 1 then 1 else 0 end)')} as special_tokens_mask, cast(n + 2 as int) as length from l
""")
def j15_single(spark, sf):
    c = table(spark, sf, "conversations").withColumn("k", F.struct("conv_id", "turn"))
    words = tx.words(F.col("text"))
    coded = op.encode_rows(c, words, op.build_vocab(c, words, 2, _PAIR_SPECIALS), "k", 1)
    cols = op.encode_single(F.col("ids"), 20, 2, 3)
    return coded.select("k.conv_id", "k.turn", *[(x if n == "length" else joined(x)).alias(n) for n, x in cols.items()])


@query("J16_add_tokens", f"""
with {VOC}, v as (select token, id from voc union all select '<unk>', 0),
new as (select unnest(['granite', 'the', 'ferry', '[TURN]']) as token, unnest([0, 1, 2, 3]) as o),
fresh as (select token, o from new where token not in (select token from v))
select token, cast(id as bigint) as id from v
union all select token, cast((select max(id) from v) + row_number() over (order by o) as bigint) from fresh
""")
def j16(spark, sf):
    return op.extend_vocab(doc_vocab(spark, sf), ["granite", "the", "ferry", "[TURN]"]).select("token", "id")


@query("J17_seq_score", f"""
with {MODEL}, s as (select p.doc_id, any_value(p.source) as source, count(*) as len, sum(ln(m.p_smooth)) / pow(count(*), 0.75) as score
 from pairs p join model m on p.w1 = m.w1 and p.w2 = m.w2 group by p.doc_id),
r as (select *, row_number() over (partition by source order by round(score, 8) desc, doc_id) as rank from s)
select source, doc_id, len, round(score, 6) as score, cast(rank as int) as rank from r where rank <= 3
""")
def j17(spark, sf):
    d = docs(spark, sf)
    scores = op.sequence_scores(d, op.ngram_array(doc_words(), 2), bigram_model(spark, sf))
    scores = scores.join(d.select("doc_id", "source"), "doc_id")
    top = op.top_per_group(scores, ["source"], [F.desc(F.round("score", 8)), "doc_id"], 3)
    return top.select("source", "doc_id", "len", F.round("score", 6).alias("score"), "rank")


@query("J18_collate", """
with r as (select doc_id, lang, n_chars, (row_number() over (order by doc_id) - 1) // 32 as batch from documents)
select batch, array_to_string(list(doc_id order by doc_id), ',') as doc_ids, array_to_string(list(lang order by doc_id), ',') as langs,
 array_to_string(list(n_chars order by doc_id), ',') as sizes from r group by batch
""")
def j18(spark, sf):
    b = op.collate(docs(spark, sf).select("doc_id", "lang", "n_chars"), "doc_id", 32, ["doc_id", "lang", "n_chars"])
    return b.select("batch", joined(F.col("doc_id")).alias("doc_ids"), F.array_join("lang", ",").alias("langs"),
                    joined(F.col("n_chars")).alias("sizes"))
