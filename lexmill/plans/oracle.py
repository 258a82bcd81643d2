"""The catalog again as plain SQL, for checking results on another engine."""

from __future__ import annotations

from lexmill.functions.text import WHITESPACE
from lexmill.operators import shards, vocab
from lexmill.operators.bpe_train import FIRST_MERGE_ID, MAX_PIECE, SPECIALS
from lexmill.plans import catalog as c

DOCS = f"""
docs AS (SELECT doc_id, lang, source, source || ':' || doc_id AS title,
                trim(text, '{WHITESPACE}') AS content FROM documents)"""


def placed(n: int) -> str:
    key = f"md5('{shards.DEFAULT_SEED}:' || doc_id), doc_id"
    return f"""{DOCS},
placed AS (SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS rnk,
                  CAST(ntile({n}) OVER (ORDER BY {key}) - 1 AS INTEGER) AS shard FROM docs),
files AS (SELECT DISTINCT shard FROM placed),
all_shards AS (SELECT CAST(range AS INTEGER) AS shard FROM range({n})),
splits AS (SELECT shard, CASE WHEN row_number() OVER (ORDER BY CAST(shard AS VARCHAR)) <= 4
                              THEN 'val' ELSE 'train' END AS split FROM all_shards)"""


CHARS = """
chars AS (SELECT doc_id, unnest(l) AS ch, generate_subscripts(l, 1) AS pos
          FROM (SELECT doc_id, string_split(content, '') AS l FROM docs)),
cvocab AS (SELECT ch, CAST(row_number() OVER (ORDER BY ch) + 2 AS INTEGER) AS id
           FROM (SELECT DISTINCT ch FROM chars WHERE ch <> ''))"""


def tokens(n: int = c.N_SHARDS) -> str:
    return f"""WITH {placed(n)}, {CHARS},
ids AS (SELECT doc_id, pos, id FROM chars JOIN cvocab USING (ch)
        UNION ALL SELECT doc_id, 0, 0 FROM docs
        UNION ALL SELECT doc_id, 1000000000, 1 FROM docs),
lens AS (SELECT doc_id, shard, rnk, CAST(length(content) + 2 AS INTEGER) AS n FROM placed),
streams AS (SELECT shard, CAST(sum(n) AS BIGINT) AS stream_len FROM lens GROUP BY shard),
toks AS (SELECT shard, id, row_number() OVER (PARTITION BY shard ORDER BY rnk, pos) - 1 AS t
         FROM ids JOIN placed USING (doc_id))"""


def pairs(context: int = c.CONTEXT, n: int = c.N_SHARDS) -> str:
    return f"""{tokens(n)},
nxt AS (SELECT shard, t, t // {context} AS chunk, id AS x,
               lead(id) OVER (PARTITION BY shard ORDER BY t) AS y FROM toks),
pairs AS (SELECT split, shard, t, chunk, x, y FROM nxt JOIN streams USING (shard)
          JOIN splits USING (shard) WHERE chunk < stream_len // {context} - 1)"""


EXAMPLES = """
SELECT split, shard, chunk, string_agg(CAST(x AS VARCHAR), ' ' ORDER BY t) AS x,
       string_agg(CAST(y AS VARCHAR), ' ' ORDER BY t) AS y
FROM pairs GROUP BY split, shard, chunk"""


def worker(w: int) -> str:
    return f"""
slices AS (SELECT split, shard,
  CAST(ntile({w}) OVER (PARTITION BY split ORDER BY CAST(shard AS VARCHAR)) - 1 AS INTEGER) AS worker
  FROM splits)"""


def ordered(w: int, n_epochs: int) -> str:
    return f"""{tokens()}, {worker(w)},
listed AS (SELECT split, worker, shard, unnest(range(greatest(stream_len // {c.CONTEXT} - 1, 0))) AS chunk
           FROM slices JOIN streams USING (shard)),
ordered AS (SELECT CAST(e.range AS INTEGER) AS epoch, split, worker, shard, chunk,
  row_number() OVER (PARTITION BY e.range, shard ORDER BY
    md5(concat_ws(':', {shards.LOADER_SEED} + worker, e.range, shard, chunk)), chunk) - 1 AS pos_in_shard
  FROM listed, range({n_epochs}) e),
placed_examples AS (SELECT *, row_number() OVER (PARTITION BY split, worker
    ORDER BY epoch, CAST(shard AS VARCHAR), pos_in_shard) - 1 AS place FROM ordered)"""


MODEL = """,
v AS (SELECT count(*) + 3 AS v FROM cvocab),
counts AS (SELECT x, y, count(*) AS n FROM pairs WHERE split = 'train' GROUP BY x, y),
model AS (SELECT x, y, n, CAST(sum(n) OVER (PARTITION BY x) AS BIGINT) AS total,
                 (n + 1.0) / (sum(n) OVER (PARTITION BY x) + 1.0 * v) AS p FROM counts, v)"""
NLL = """,
totals AS (SELECT DISTINCT x, total FROM model),
scored AS (SELECT q.*, -ln(coalesce(m.p, 1.0 / (coalesce(s.total, 0) + 1.0 * v))) AS nll
           FROM q LEFT JOIN model m USING (x, y) LEFT JOIN totals s USING (x), v)"""
RANKED = f""",
kept AS (SELECT x, y, n, p, rank FROM (
  SELECT *, rank() OVER (PARTITION BY x ORDER BY p DESC) AS rank FROM model)
  WHERE rank <= {c.TOP_K}),
soft AS (SELECT x, y, e / sum(e) OVER (PARTITION BY x) AS prob FROM (
  SELECT x, y, exp(ln(p) / {c.TEMPERATURE} - max(ln(p) / {c.TEMPERATURE}) OVER (PARTITION BY x)) AS e
  FROM kept))"""

LOG = """
log AS (SELECT user_id AS run, ts, value AS loss,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step FROM events)"""

LINES = f"""{DOCS},
lines AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS line
          FROM (SELECT doc_id, string_split(content, chr(10)) AS l FROM docs)),
short AS (SELECT * FROM lines)"""

# Words at U+0020, their parts without digits, control characters and other white space.
SEGMENTS = f"""{LINES},
words AS (SELECT '{vocab.WORD_START}' || w AS word, count(*) AS n FROM (
  SELECT unnest(string_split(line, ' ')) AS w FROM short) WHERE w <> '' GROUP BY w),
segments AS (SELECT segment, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT unnest(regexp_extract_all(word,
    '▁[^▁0-9\\x00-\\x1f\\x7f-\\x{{a0}}]+|[^▁0-9\\x00-\\x1f\\x7f-\\x{{a0}}]{{2,}}')) AS segment, n FROM words)
  GROUP BY segment)"""

def merges(size: int) -> str:
    """One merge per recursion step; every symbol is written between chr(1) and chr(2)."""
    return f"""{SEGMENTS},
alphabet AS (SELECT ch, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT unnest(string_split(word, '')) AS ch, n FROM words)
  WHERE NOT regexp_matches(ch, '[\\x00-\\x1f\\x7f-\\x{{a0}}]') GROUP BY ch),
spelled AS (SELECT {marked('segment')} AS s, n FROM segments),
steps AS (
  SELECT 0 AS step, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b, s, n FROM spelled
  UNION ALL
  SELECT step + 1, best.a, best.b, {joined('s')}, n
  FROM (SELECT step, s, n FROM steps),
       (SELECT a, b FROM (
          SELECT l[i] AS a, l[i + 1] AS b, sum(n) AS m FROM (
            SELECT l, n, unnest(range(1, len(l))) AS i FROM (
              SELECT string_split(s[2:-2], chr(2) || chr(1)) AS l, n FROM steps))
          GROUP BY 1, 2)
        WHERE length(a || b) <= {MAX_PIECE}
        ORDER BY m DESC, a, b LIMIT 1) best
  WHERE step < {size - FIRST_MERGE_ID} - (SELECT count(*) FROM alphabet)),
merges AS (SELECT DISTINCT step, a, b, a || b AS piece FROM steps WHERE step > 0),
pieces AS (
  SELECT 0 AS part, 0 AS i, '<unk>' AS piece, 'special' AS kind UNION ALL SELECT 0, 1, '<s>', 'special'
  UNION ALL SELECT 0, 2, '</s>', 'special'
  UNION ALL SELECT 1, range, '<0x' || printf('%02X', range) || '>', 'byte' FROM range(256)
  UNION ALL SELECT 2, step, piece, 'merge' FROM merges
  UNION ALL SELECT 3, row_number() OVER (ORDER BY n DESC, ch), ch, 'char' FROM alphabet),
ids AS (SELECT CAST(row_number() OVER (ORDER BY part, i) - 1 AS INTEGER) AS id, piece, kind FROM pieces)"""


def marked(text: str) -> str:
    return f"chr(1) || array_to_string(string_split({text}, ''), chr(2) || chr(1)) || chr(2)"


def joined(symbols: str) -> str:
    return f"replace({symbols}, chr(1) || a || chr(2) || chr(1) || b || chr(2), chr(1) || a || b || chr(2))"


def encoded(size: int) -> str:
    """Ids of all documents: every distinct word goes through the merges in order."""
    return f"""WITH RECURSIVE {merges(size)},
places AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS place
           FROM (SELECT doc_id, string_split(content, ' ') AS l FROM docs)),
worked AS (
  SELECT 0 AS step, w, {marked(f"'{vocab.WORD_START}' || w")} AS e FROM (SELECT DISTINCT w FROM places WHERE w <> '')
  UNION ALL SELECT m.step, w, {joined('e')} FROM worked JOIN merges m ON m.step = worked.step + 1),
symbols AS (SELECT w, unnest(l) AS symbol, generate_subscripts(l, 1) AS i FROM (
  SELECT w, string_split(e[2:-2], chr(2) || chr(1)) AS l FROM worked WHERE step = (SELECT max(step) FROM merges))),
known AS (SELECT id, piece FROM ids WHERE kind IN ('merge', 'char')),
word_ids AS (SELECT w, string_agg(coalesce(CAST(id AS VARCHAR), array_to_string(list_transform(range(1, strlen(symbol) + 1),
    lambda k: ('0x' || hex(encode(symbol))[2 * k - 1:2 * k])::INT + {len(SPECIALS)}), ' ')), ' ' ORDER BY i) AS t
  FROM symbols LEFT JOIN known ON piece = symbol GROUP BY w),
doc_ids AS (SELECT doc_id, coalesce(string_agg(t, ' ' ORDER BY place), '') AS ids
  FROM places LEFT JOIN word_ids USING (w) GROUP BY doc_id)"""


def oracle_sql() -> dict[str, str]:
    half = f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents)
SELECT doc_id, source || ':' || doc_id AS title, text AS content FROM r WHERE i <= round(n * 0.5)"""
    ws_words = f"list_filter(regexp_split_to_array(content, '[{_class()}]+'), lambda w: w <> '')"
    q: dict[str, str] = {"corpus_half": half}
    q["strip_words"] = f"WITH {DOCS} SELECT doc_id, len({ws_words}) AS n_words FROM docs"
    q["shuffle_shards"] = f"WITH {placed(c.N_SHARDS)} SELECT doc_id, shard, rnk FROM placed"
    q["default_shards"] = f"""WITH {placed(shards.DEFAULT_SHARDS)}
SELECT shard, count(*) AS n_docs, min(doc_id) AS first_doc,
       max(md5('{shards.DEFAULT_SEED}:' || doc_id)) AS last_key FROM placed GROUP BY shard"""
    existing = placed(c.N_SHARDS).replace("FROM all_shards", "FROM files")
    q["split_shards"] = f"WITH {existing} SELECT shard, split FROM splits"
    q["worker_slices"] = f"WITH {existing}, {worker(c.WORKERS)} SELECT split, shard, worker FROM slices"
    q["train_lines"] = f"""WITH {LINES} SELECT count(*) AS n_lines,
count(*) FILTER (WHERE strlen(line) > 16384) AS n_dropped FROM lines"""
    q["line_sample"] = f"""WITH {LINES} SELECT doc_id, line_no, line FROM short
ORDER BY md5('{c.SAMPLE_SEED}:' || doc_id || ':' || line_no), doc_id, line_no LIMIT {c.SAMPLE_LINES}"""
    q["text_export"] = f"""WITH {LINES} SELECT count(*) AS n_lines,
(SELECT CAST(sum(len({ws_words})) AS BIGINT) FROM docs) AS n_words FROM lines"""
    q["char_vocab"] = f"""WITH {DOCS}, {CHARS} SELECT ch, id FROM cvocab
UNION ALL VALUES ('<s>', 0), ('</s>', 1), ('<unk>', 2)"""
    q["distinct_chars"] = f"WITH {DOCS}, {CHARS} SELECT count(*) AS n_chars FROM cvocab"
    q["alphabet_freq"] = f"""WITH {LINES}, n AS (SELECT ch, count(*) AS n FROM (
  SELECT unnest(string_split(line, '')) AS ch FROM short) WHERE ch <> '' GROUP BY ch)
SELECT row_number() OVER (ORDER BY n DESC, ch) - 1 AS rank, ch, n FROM n"""
    q["char_encode"] = f"""{tokens()} SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS tokens
FROM ids GROUP BY doc_id"""
    q["char_roundtrip"] = f"""WITH {DOCS}, {CHARS}, known AS (SELECT DISTINCT unnest(string_split(text, '')) AS k
  FROM documents WHERE lang = 'en')
SELECT doc_id, coalesce(string_agg(CASE WHEN k IS NULL AND ch <> '' THEN '<unk>' ELSE ch END, '' ORDER BY pos), '') AS text
FROM chars LEFT JOIN known ON ch = k GROUP BY doc_id"""
    q["doc_offsets"] = f"""{tokens()} SELECT shard, doc_id, CAST(coalesce(sum(n) OVER (PARTITION BY shard ORDER BY rnk
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", n, stream_len
FROM lens JOIN streams USING (shard)"""
    q["uint16_violations"] = f"""{tokens()} SELECT shard, count(*) FILTER (WHERE id < 0 OR id > 65535) AS n_bad
FROM toks GROUP BY shard"""
    q["bad_shards"] = f"""{tokens()}, l AS (SELECT shard, coalesce(stream_len, 0) AS stream_len
  FROM all_shards LEFT JOIN streams USING (shard))
SELECT shard, stream_len FROM l WHERE stream_len // {8 * c.CONTEXT * c.CONTEXT} - 1 <= 0"""
    q["chunks"] = pairs() + EXAMPLES
    q["sql_chunks"] = q["chunks"]
    q["sql_char_roundtrip"] = f"""WITH {DOCS}, {CHARS}
SELECT doc_id, len({ws_words}) AS n_words, coalesce(i, '') AS ids, content AS text FROM docs LEFT JOIN (
  SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS i FROM chars JOIN cvocab USING (ch) GROUP BY doc_id)
USING (doc_id)"""
    q["epochs"] = f"""{ordered(1, c.EPOCHS)} SELECT epoch, split, count(*) AS n_examples
FROM ordered GROUP BY epoch, split"""
    q["chunk_order"] = f"""{ordered(c.WORKERS, c.EPOCHS)}
SELECT epoch, split, worker, shard, chunk, pos_in_shard FROM ordered"""
    q["batches"] = f"""{ordered(c.WORKERS, c.EPOCHS)}
SELECT split, epoch, worker, place // {c.BATCH} AS batch_id, CAST(place % {c.BATCH} AS INTEGER) AS pos, shard, chunk
FROM placed_examples"""
    lists = "list(x ORDER BY t) || [arg_max(y, t)]"
    q["prefixes"] = f"""{pairs(c.PREFIX_CONTEXT)},
whole AS (SELECT {lists} AS ids FROM pairs GROUP BY shard, chunk),
rows AS (SELECT array_to_string(ids[1:i.range], ' ') AS prefix, ids[i.range + 1] AS target
         FROM whole, range(1, {c.PREFIX_CONTEXT + 1}) i)
SELECT prefix, target, count(*) AS n FROM rows GROUP BY prefix, target"""
    q["shard_stats"] = f"""{tokens()}, d AS (SELECT shard, count(*) AS n_docs FROM placed GROUP BY shard)
SELECT shard, coalesce(stream_len, 0) AS n_tokens, round(stream_len / n_docs, 6) AS mean_len
FROM all_shards LEFT JOIN streams USING (shard) LEFT JOIN d USING (shard)"""
    q["corpus_totals"] = f"""WITH {DOCS} SELECT lang, source, count(*) AS n_docs,
CAST(sum(length(content) + 2) AS BIGINT) AS n_tokens FROM docs GROUP BY ROLLUP (lang, source)"""
    q["shard_count"] = f"WITH {placed(c.N_SHARDS)} SELECT count(*) AS n_shards FROM files"
    q["steps_plan"] = f"""{tokens()} SELECT split, CAST(sum(stream_len) AS BIGINT) AS n_tokens,
CAST({4 * c.BATCH * c.CONTEXT} AS BIGINT) AS tokens_per_step,
round(sum(stream_len) / {c.BATCH * c.CONTEXT}, 6) AS n_steps
FROM streams JOIN splits USING (shard) GROUP BY split"""
    q["split_summary"] = f"""{tokens()}, s AS (SELECT split, sum(stream_len) AS n_tokens,
  sum(greatest(stream_len // {c.CONTEXT} - 1, 0)) AS n_examples FROM streams JOIN splits USING (shard) GROUP BY split),
d AS (SELECT split, count(*) AS n_docs FROM placed JOIN splits USING (shard) GROUP BY split)
SELECT split, n_docs, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_examples AS BIGINT) AS n_examples,
round(n_tokens / n_docs, 6) AS mean_len FROM s JOIN d USING (split)"""
    q["loglog_fit"] = f"""WITH w AS (SELECT lang, {ws_words.replace('content', 'text')} AS w FROM documents),
f AS (SELECT lang AS grp, regr_slope(log10(len(list_distinct(w))), log10(len(w))) AS m,
  regr_intercept(log10(len(list_distinct(w))), log10(len(w))) AS c FROM w WHERE len(w) > 0 GROUP BY lang)
SELECT grp, round(m, 6) AS m, round(c, 6) AS c, round(pow(10, m * log10(1000) + c), 4) AS y_at_1000 FROM f"""
    q["pair_counts"] = f"""WITH {SEGMENTS}
SELECT l[i] AS a, l[i + 1] AS b, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT l, n, unnest(range(1, len(l))) AS i FROM (SELECT string_split(segment, '') AS l, n FROM segments))
GROUP BY 1, 2"""
    q["bpe_vocab"] = f"""WITH RECURSIVE {merges(c.BPE_SIZE)}
SELECT id, piece, CAST(0 - greatest(id - {FIRST_MERGE_ID}, 0) AS DOUBLE) AS score, kind FROM ids"""
    q["bpe_dictionary_ids"] = f"{encoded(c.SMALL_BPE_SIZE)} SELECT doc_id, ids FROM doc_ids"
    single = "trim(regexp_replace(replace(content, '▁', ' '), ' +', ' ', 'g'), ' ')"
    q["bpe_sql_ids"] = f"""{encoded(c.SMALL_BPE_SIZE)}
SELECT doc_id, ids, {single} AS text FROM doc_ids JOIN docs USING (doc_id)"""
    q["bpe_roundtrip"] = f"""WITH {DOCS} SELECT doc_id,
trim(regexp_replace(replace(content, '▁', ' '), ' +', ' ', 'g'), ' ') AS text FROM docs"""
    q["next_counts"] = pairs() + MODEL + " SELECT x, y, n, total, round(p, 9) AS p FROM model"
    q["cross_entropy"] = f"""{pairs()}{MODEL}, q AS (SELECT split, x, y FROM pairs){NLL}
SELECT split, count(*) AS n_targets, round(avg(nll), 6) AS loss FROM scored GROUP BY split"""
    one = ordered(1, 1)[len(tokens()) :]
    q["eval_by_split"] = f"""{pairs()}{MODEL}{one},
q AS (SELECT p.split, place // {c.BATCH} AS batch_id, x, y FROM pairs p
  JOIN placed_examples o ON p.shard = o.shard AND p.chunk = o.chunk
  WHERE place // {c.BATCH} < {c.EVAL_ITERS}){NLL},
b AS (SELECT split, batch_id, avg(nll) AS l FROM scored GROUP BY split, batch_id)
SELECT split, count(*) AS n_batches, round(avg(l), 6) AS loss FROM b GROUP BY split"""
    q["topk_next"] = pairs() + MODEL + RANKED + " SELECT x, y, n, rank FROM kept"
    q["softmax_next"] = pairs() + MODEL + RANKED + " SELECT x, y, round(prob, 9) AS prob FROM soft"
    q["greedy_next"] = pairs() + MODEL + """ SELECT x, y FROM (
SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY p DESC, y) AS r FROM model) WHERE r = 1"""
    q["draw_next"] = pairs() + MODEL + RANKED + f""",
cum AS (SELECT x, y, sum(prob) OVER (PARTITION BY x ORDER BY y) AS cum, max(y) OVER (PARTITION BY x) AS last,
  CAST(('0x' || md5('{c.DRAW_SEED}:' || x)[1:13]) AS BIGINT) / pow(16.0, 13) AS u FROM soft)
SELECT x, min(y) AS y FROM cum WHERE cum > u OR y = last GROUP BY x"""
    q["run_every_k"] = f"WITH {LOG} SELECT run, step, loss FROM log WHERE step % {c.EVERY} = 0"
    q["run_step_seconds"] = f"""WITH {LOG} SELECT run, step,
round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run ORDER BY step))) / 1e6, 6) AS seconds FROM log"""
    q["run_best"] = f"""WITH {LOG}, b AS (SELECT *, loss < coalesce(min(loss) OVER (PARTITION BY run ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9) AS improved FROM log)
SELECT run, step, improved, improved AND step > 0 AS saved FROM b"""
    q["run_ema"] = f"""WITH RECURSIVE {LOG}, e AS (SELECT run, step, loss AS ema FROM log WHERE step = 5
  UNION ALL SELECT l.run, l.step, 0.9 * e.ema + 0.1 * l.loss FROM e JOIN log l ON l.run = e.run AND l.step = e.step + 1)
SELECT run, step, CAST(round(CAST(round(ema, 10) AS DECIMAL(20,10)), 6) AS DOUBLE) AS ema FROM e"""
    q["json_roundtrip"] = f"""WITH {placed(c.N_SHARDS)}
SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY rnk) - 1 AS rnk, p.title, d.text AS content
FROM placed p JOIN documents d USING (doc_id)"""
    q["tokbin_roundtrip"] = f"""{tokens()} SELECT shard, t // {c.BLOCK_TOKENS} * {c.BLOCK_TOKENS} AS start,
string_agg(CAST(id AS VARCHAR), ' ' ORDER BY t) AS tokens FROM toks GROUP BY 1, 2"""
    q["stream_ingest"] = pairs(c.CONTEXT, c.STREAM_SHARDS) + EXAMPLES.replace("SELECT split, ", "SELECT ", 1)
    q["stream_growing"] = q["stream_ingest"]
    q["stream_counts"] = f"""{tokens(c.STREAM_SHARDS)} SELECT shard, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM lens GROUP BY shard"""
    return q


def _class() -> str:
    # The white-space class in the regular-expression syntax of the other engine.
    return r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
