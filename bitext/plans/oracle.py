"""DuckDB twins of the registered queries (same column names and values).

Shared pieces are CTEs written once and combined per query.  Patterns are the
RE2 spellings of the Java patterns in ``bitext.functions.text``.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# RE2 spellings of the text patterns.
SPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}"
WHITE_SPACE = r"\x{09}-\x{0D}\x{20}\x{85}\p{Z}"
WORD_CHARS = (
    r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}"
    r"\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}"
)
WS = rf"^[{SPACE}]+|[{SPACE}]+$"
WORD = rf"[^{SPACE}]+"
PRETOK = rf"[{WORD_CHARS}]+|[^{WORD_CHARS}{WHITE_SPACE}]+"
NOISE = r"[\x{0640}\x{064B}-\x{0652}]"
# ---------------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}', '', 'g')"


def wc(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{WORD}'))"


PAIRS = f"""pairs AS (
  SELECT CAST(doc_id * 100000 + k AS BIGINT) AS pair_id, {strip('a[k]')} AS src, {strip('a[k + 1]')} AS tgt
  FROM (SELECT doc_id, a, unnest(generate_series(1, len(a) - 1, 2)) AS k
        FROM (SELECT doc_id, regexp_split_to_array(text, '[.\\n]+') AS a FROM documents)
        WHERE len(a) >= 2))"""

NOISY = """noisy AS (
  SELECT pair_id, '  ' || src || '  ' AS src, replace(tgt, 'e', 'e' || chr(1600)) AS tgt FROM pairs)"""

def prep(sample: int | None = None) -> str:
    """Cleaned, word-filtered and split (90 %) pairs: all, or the first ``sample`` in hash order."""
    sampled = "true" if sample is None else f"row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) <= {sample}"
    return f"""flags AS (
  SELECT pair_id, {strip('src')} AS src, {strip(f"regexp_replace(tgt, '{NOISE}', '', 'g')")} AS tgt, {sampled} AS sampled
  FROM pairs),
kflags AS (
  SELECT *, sampled AND {wc('src')} BETWEEN 1 AND 40 AND {wc('tgt')} BETWEEN 1 AND 40 AS kept FROM flags),
kept AS (
  SELECT pair_id, src, tgt,
         CASE WHEN row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id)
                   <= CAST(floor(0.9::DOUBLE * count(*) OVER ()) AS BIGINT) THEN 'train' ELSE 'val' END AS split
  FROM kflags WHERE kept),
allflags AS (
  SELECT k.*, s.split FROM kflags k LEFT JOIN kept s USING (pair_id))"""


PREP = prep()


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE["scan_pairs"] = w(PAIRS) + "SELECT * FROM pairs"
ORACLE["normalize_pairs"] = w(PAIRS) + "SELECT pair_id, src, tgt FROM pairs"
ORACLE["monolingual"] = w(PAIRS) + "SELECT pair_id, tgt AS text FROM pairs"
ORACLE["clean_noise"] = w(PAIRS, NOISY) + (
    f"SELECT pair_id, {strip('src')} AS src, {strip(f"regexp_replace(tgt, '{NOISE}', '', 'g')")} AS tgt FROM noisy"
)
ORACLE["strip_text"] = w(PAIRS, NOISY) + (
    f"SELECT pair_id, text, CAST(length(text) AS INTEGER) AS n_chars FROM "
    f"(SELECT pair_id, {strip("src || chr(9) || chr(10)")} AS text FROM noisy)"
)
ORACLE["filter_word_count"] = w(PAIRS) + (
    f"SELECT * FROM pairs WHERE {wc('src')} BETWEEN 1 AND 40 AND {wc('tgt')} BETWEEN 1 AND 40"
)
ORACLE["over_length_flag"] = w(PAIRS) + (
    f"SELECT pair_id, CAST({wc('src')} AS INTEGER) AS n_words, {wc('src')} > 40 AS over_length FROM pairs"
)
ORACLE["seeded_sample"] = w(PAIRS) + (
    "SELECT pair_id, src, tgt FROM pairs QUALIFY row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) <= 5000"
)
ORACLE["train_val_split"] = w(PAIRS, PREP) + "SELECT pair_id, split FROM kept"
ORACLE["subset_by_key"] = w(PAIRS, PREP) + (
    "SELECT * FROM pairs WHERE pair_id IN (SELECT pair_id FROM kept WHERE split = 'val')"
)
EPOCH = """batches AS (
  SELECT pair_id, CAST(row_number() OVER (ORDER BY md5('42:1:' || pair_id), pair_id) - 1 AS BIGINT) AS rank
  FROM kept WHERE split = 'train')"""
ORACLE["epoch_batches"] = w(PAIRS, PREP, EPOCH) + (
    "SELECT pair_id, rank, CAST(rank // 32 AS BIGINT) AS batch_id FROM batches"
)
ORACLE["ordered_batches"] = w(PAIRS, PREP) + (
    "SELECT pair_id, rank, CAST(rank // 64 AS BIGINT) AS batch_id FROM "
    "(SELECT pair_id, CAST(row_number() OVER (ORDER BY pair_id) - 1 AS BIGINT) AS rank FROM kept WHERE split = 'val')"
)
ORACLE["limit_batches"] = w(PAIRS, PREP, EPOCH) + (
    "SELECT pair_id, CAST(rank // 32 AS BIGINT) AS batch_id FROM batches WHERE rank // 32 < 100"
)
ORACLE["split_check"] = w(PAIRS, PREP) + """SELECT * FROM (VALUES
  ('all', (SELECT count(*) FROM kept)),
  ('train', (SELECT count(*) FROM kept WHERE split = 'train')),
  ('val', (SELECT count(*) FROM kept WHERE split = 'val')),
  ('union', (SELECT count(*) FROM (SELECT pair_id FROM kept WHERE split = 'train' UNION SELECT pair_id FROM kept WHERE split = 'val'))),
  ('intersect', (SELECT count(*) FROM (SELECT pair_id FROM kept WHERE split = 'train' INTERSECT SELECT pair_id FROM kept WHERE split = 'val'))),
  ('missing', (SELECT count(*) FROM (SELECT pair_id FROM kept EXCEPT ALL (SELECT pair_id FROM kept WHERE split = 'train' UNION ALL SELECT pair_id FROM kept WHERE split = 'val'))))
) AS t(name, rows)"""


# ----------------------------------------------------------------- tokenizer twins
def symstr(word: str) -> str:
    """SQL: symbol string of a word, last character suffixed with </w>."""
    return (
        f"(' ' || array_to_string(list_transform(regexp_extract_all({word}, '(?s).'), "
        f"lambda x, i: CASE WHEN i = len(regexp_extract_all({word}, '(?s).')) THEN x || '</w>' ELSE x END), '  ') || ' ')"
    )


def pair_counts(w: str) -> str:
    return (
        "SELECT sy[i] AS left_tok, sy[i + 1] AS right_tok, CAST(sum(freq) AS BIGINT) AS freq FROM "
        f"(SELECT freq, sy, unnest(range(1, len(sy))) AS i FROM (SELECT freq, string_split(trim(s), '  ') AS sy FROM {w})) "
        "GROUP BY 1, 2"
    )


def bpe_ctes(corpus: str, m: int, pre: str = "") -> list[str]:
    """One-merge-at-a-time BPE training unrolled into m rounds of CTEs.

    ``corpus`` is a SELECT producing a ``text`` column.  Defines
    ``{pre}wf, {pre}w0..w{m}, {pre}p1..p{m}, {pre}merges, {pre}vocab``.
    """
    c = [
        f"{pre}wf AS MATERIALIZED (SELECT word, CAST(count(*) AS BIGINT) AS freq FROM "
        f"(SELECT unnest(regexp_extract_all(text, '{PRETOK}')) AS word FROM ({corpus})) GROUP BY word)",
        f"{pre}w0 AS MATERIALIZED (SELECT word, freq, {symstr('word')} AS s FROM {pre}wf)",
    ]
    for r in range(1, m + 1):
        c.append(
            f"{pre}p{r} AS MATERIALIZED (SELECT left_tok, right_tok, ' ' || left_tok || '  ' || right_tok || ' ' AS pat, "
            f"' ' || left_tok || right_tok || ' ' AS rep FROM ({pair_counts(f'{pre}w{r - 1}')}) "
            "ORDER BY freq DESC, left_tok, right_tok LIMIT 1)"
        )
        c.append(
            f"{pre}w{r} AS MATERIALIZED (SELECT word, freq, replace(s, (SELECT pat FROM {pre}p{r}), "
            f"(SELECT rep FROM {pre}p{r})) AS s FROM {pre}w{r - 1})"
        )
    if m:
        merges = " UNION ALL ".join(
            f"SELECT {r - 1} AS rank, left_tok, right_tok FROM {pre}p{r}" for r in range(1, m + 1)
        )
    else:
        merges = "SELECT 0 AS rank, '' AS left_tok, '' AS right_tok WHERE false"
    c.append(f"{pre}merges AS MATERIALIZED ({merges})")
    specials = ", ".join(f"('{t}', {i})" for i, t in enumerate(
        ["[UNK]", "[PAD]", "[CLS]", "[SEP]", "[EOS]", "[SOS]", "[BOS]", "[MASK]"]))
    c.append(
        f"{pre}vocab AS MATERIALIZED (SELECT token, CAST(row_number() OVER (ORDER BY g, o) - 1 AS INTEGER) AS id FROM ("
        f"SELECT token, g, o FROM ("
        f"SELECT token, 0 AS g, o FROM (VALUES {specials}) t(token, o) "
        f"UNION ALL SELECT token, 1 AS g, row_number() OVER (ORDER BY token) AS o FROM "
        f"(SELECT DISTINCT unnest(string_split(trim(s), '  ')) AS token FROM {pre}w0) "
        f"UNION ALL SELECT left_tok || right_tok AS token, 2 AS g, rank AS o FROM {pre}merges) "
        f"QUALIFY row_number() OVER (PARTITION BY token ORDER BY g, o) = 1))"
    )
    return c


def merged(s: str, m: int, pre: str = "") -> str:
    for r in range(1, m + 1):
        s = f"replace({s}, (SELECT pat FROM {pre}p{r}), (SELECT rep FROM {pre}p{r}))"
    return s


def encode_ctes(src: str, m: int, pre: str = "", name: str = "enc") -> list[str]:
    """``{name}_sym(pair_id, i, j, id)`` and ``{name}(pair_id, ids)`` for ``src(pair_id, text)``."""
    return [
        f"{name}_occ AS (SELECT pair_id, unnest(a) AS w, unnest(range(len(a))) AS i FROM "
        f"(SELECT pair_id, regexp_extract_all(text, '{PRETOK}') AS a FROM {src}))",
        f"{name}_sym AS MATERIALIZED (SELECT o.pair_id, o.i, o.j, coalesce(v.id, 0) AS id FROM "
        f"(SELECT pair_id, i, unnest(sy) AS sym, unnest(range(len(sy))) AS j FROM "
        f"(SELECT pair_id, i, string_split(trim({merged(symstr('w'), m, pre)}), '  ') AS sy FROM {name}_occ)) o "
        f"LEFT JOIN {pre}vocab v ON v.token = o.sym)",
        f"{name} AS MATERIALIZED (SELECT pair_id, list(id ORDER BY i, j) AS ids FROM {name}_sym GROUP BY pair_id)",
    ]


TRAIN_SRC = "SELECT src AS text FROM kept WHERE split = 'train'"
TRAIN_TGT = "SELECT tgt AS text FROM kept WHERE split = 'train'"
KEPT_SRC = "kept_src AS (SELECT pair_id, src AS text FROM kept)"
KEPT_TGT = "kept_tgt AS (SELECT pair_id, tgt AS text FROM kept)"
M = 10

ORACLE["pretokenize"] = w(PAIRS) + f"SELECT pair_id, regexp_extract_all(src, '{PRETOK}') AS tokens FROM pairs"
ORACLE["word_freq"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, 0)) + "SELECT word, freq FROM wf"
ORACLE["alphabet"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, 0)) + (
    "SELECT symbol, CAST(sum(freq) AS BIGINT) AS freq FROM "
    "(SELECT unnest(string_split(trim(s), '  ')) AS symbol, freq FROM w0) GROUP BY symbol"
)
ORACLE["pair_freq"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, 0)) + pair_counts("w0")
ORACLE["bpe_merge_step"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, 1)) + "SELECT word, freq, s FROM w1"
ORACLE["bpe_train"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M)) + (
    "SELECT CAST(rank AS INTEGER) AS rank, left_tok, right_tok FROM merges"
)
ORACLE["vocab_table"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M)) + "SELECT token, id FROM vocab"
ORACLE["vocab_size"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M)) + (
    "SELECT CAST(count(*) AS BIGINT) AS vocab_size FROM vocab"
)
ORACLE["bpe_encode"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M), KEPT_SRC, *encode_ctes("kept_src", M)) + (
    "SELECT k.pair_id, coalesce(e.ids, []::INTEGER[]) AS src_ids FROM kept k LEFT JOIN enc e USING (pair_id)"
)
ORACLE["bpe_encode_chars"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, 0), KEPT_SRC, *encode_ctes("kept_src", 0)) + (
    "SELECT k.pair_id, coalesce(e.ids, []::INTEGER[]) AS src_ids FROM kept k LEFT JOIN enc e USING (pair_id)"
)
ORACLE["bpe_decode"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M), KEPT_SRC, *encode_ctes("kept_src", M)) + (
    f"SELECT k.pair_id, coalesce({strip('replace(d.t, ' + chr(39) + '</w>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')')}, '') AS text "
    "FROM kept k LEFT JOIN (SELECT e.pair_id, string_agg(v.token, '' ORDER BY e.i, e.j) AS t "
    "FROM enc_sym e JOIN vocab v ON v.id = e.id WHERE e.id >= 8 GROUP BY e.pair_id) d USING (pair_id)"
)
DETOK_BEFORE = rf"[{SPACE}]+([،,.؟?!:;)\]»])"
DETOK_AFTER = rf"([(\[«])[{SPACE}]+"


def detok_sql(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace({x}, '{DETOK_BEFORE}', '\\1', 'g'), '{DETOK_AFTER}', '\\1', 'g')")


ORACLE["detok"] = w(PAIRS) + (
    f"SELECT pair_id, {detok_sql(f"array_to_string(regexp_extract_all(src, '{PRETOK}'), ' ')")} AS text FROM pairs"
)
ORACLE["filter_token_length"] = w(
    PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M, "s_"), *bpe_ctes(TRAIN_TGT, M, "t_"), KEPT_SRC, KEPT_TGT,
    *encode_ctes("kept_src", M, "s_", "es"), *encode_ctes("kept_tgt", M, "t_", "et"),
) + (
    "SELECT k.pair_id, k.split FROM kept k JOIN es ON es.pair_id = k.pair_id JOIN et ON et.pair_id = k.pair_id "
    "WHERE len(es.ids) <= 158 AND len(et.ids) <= 158"
)


# ----------------------------------------------------------------- layout twins
ENC2 = [
    *bpe_ctes(TRAIN_SRC, M, "s_"), *bpe_ctes(TRAIN_TGT, M, "t_"), KEPT_SRC, KEPT_TGT,
    *encode_ctes("kept_src", M, "s_", "es"), *encode_ctes("kept_tgt", M, "t_", "et"),
    "encoded AS MATERIALIZED (SELECT k.pair_id, k.split, k.src, k.tgt, coalesce(es.ids, []::INTEGER[]) AS src_ids, "
    "coalesce(et.ids, []::INTEGER[]) AS tgt_ids FROM kept k LEFT JOIN es USING (pair_id) LEFT JOIN et USING (pair_id))",
    "fit AS MATERIALIZED (SELECT * FROM encoded WHERE len(src_ids) <= 158 AND len(tgt_ids) <= 158)",
]


def enc_in(x: str) -> str:
    return f"([5]::INTEGER[] || {x} || [4]::INTEGER[] || repeat([1]::INTEGER[], greatest(160 - len({x}) - 2, 0)))"


def dec_in(x: str) -> str:
    return f"([5]::INTEGER[] || {x} || repeat([1]::INTEGER[], greatest(160 - len({x}) - 1, 0)))"


def lab(x: str) -> str:
    return f"({x} || [4]::INTEGER[] || repeat([1]::INTEGER[], greatest(160 - len({x}) - 1, 0)))"


ORACLE["funnel"] = w(PAIRS, prep(300000), *ENC2) + """SELECT stage, CAST(rows AS BIGINT) AS rows FROM (
  SELECT count(*) AS input, count(*) FILTER (WHERE sampled) AS sampled, count(*) FILTER (WHERE kept) AS word_filter,
         count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val,
         (SELECT count(*) FROM fit WHERE split = 'train') AS train_tokens, (SELECT count(*) FROM fit WHERE split = 'val') AS val_tokens
  FROM allflags) UNPIVOT (rows FOR stage IN (input, sampled, word_filter, train, val, train_tokens, val_tokens))"""
L0 = w(PAIRS, PREP, *ENC2)
ORACLE["encoder_input"] = L0 + f"SELECT pair_id, {enc_in('src_ids')} AS encoder_input FROM fit"
ORACLE["decoder_input"] = L0 + f"SELECT pair_id, {dec_in('tgt_ids')} AS decoder_input FROM fit"
ORACLE["labels"] = L0 + f"SELECT pair_id, {lab('tgt_ids')} AS labels FROM fit"
ORACLE["padding_mask"] = L0 + (
    f"SELECT pair_id, list_transform({enc_in('src_ids')}, lambda x: x <> 1) AS encoder_mask FROM fit"
)
ORACLE["causal_mask"] = L0 + (
    "SELECT size, list_transform(range(size), lambda r: list_transform(range(size), lambda c: c <= r)) AS mask "
    "FROM (SELECT DISTINCT CAST(len(tgt_ids) + 1 AS INTEGER) AS size FROM fit)"
)
ORACLE["decoder_mask"] = L0 + (
    "SELECT valid_len, list_transform(range(160), lambda r: list_transform(range(160), lambda c: c <= r AND c < valid_len)) AS mask "
    "FROM (SELECT DISTINCT CAST(len(tgt_ids) + 1 AS INTEGER) AS valid_len FROM fit)"
)
ORACLE["model_rows"] = L0 + (
    f"SELECT pair_id, {enc_in('src_ids')} AS encoder_input, {dec_in('tgt_ids')} AS decoder_input, "
    f"{lab('tgt_ids')} AS labels, list_transform({enc_in('src_ids')}, lambda x: x <> 1) AS encoder_mask, "
    "CAST(len(src_ids) + 2 AS INTEGER) AS encoder_valid_len, CAST(len(tgt_ids) + 1 AS INTEGER) AS decoder_valid_len, "
    "src AS src_text, tgt AS tgt_text FROM fit"
)
ORACLE["row_lookup"] = L0 + (
    f"SELECT rank, pair_id, {enc_in('src_ids')} AS encoder_input, {dec_in('tgt_ids')} AS decoder_input, {lab('tgt_ids')} AS labels "
    "FROM (SELECT *, CAST(row_number() OVER (ORDER BY pair_id) - 1 AS BIGINT) AS rank FROM fit) WHERE rank % 97 = 0 AND rank < 9700"
)
TB = """tb AS (SELECT *, CAST(rank // 32 AS BIGINT) AS batch_id FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY md5('42:1:' || pair_id), pair_id) - 1 AS BIGINT) AS rank
  FROM fit WHERE split = 'train'))"""
ORACLE["collate"] = w(PAIRS, PREP, *ENC2, TB) + (
    f"SELECT batch_id, list(pair_id ORDER BY rank) AS pair_id, list({enc_in('src_ids')} ORDER BY rank) AS encoder_input, "
    f"list({dec_in('tgt_ids')} ORDER BY rank) AS decoder_input, list({lab('tgt_ids')} ORDER BY rank) AS labels, "
    f"list(list_transform({enc_in('src_ids')}, lambda x: x <> 1) ORDER BY rank) AS encoder_mask, "
    "list(CAST(len(tgt_ids) + 1 AS INTEGER) ORDER BY rank) AS decoder_valid_len FROM tb GROUP BY batch_id"
)
ORACLE["padding_stats"] = w(PAIRS, PREP, *ENC2, TB) + (
    "SELECT batch_id, rows, pad_positions, positions, round(pad_positions / positions, 6) AS pad_share FROM ("
    "SELECT batch_id, count(*) AS rows, CAST(sum(160 - len(tgt_ids) - 1) AS BIGINT) AS pad_positions, "
    "CAST(sum(160) AS BIGINT) AS positions FROM tb GROUP BY batch_id)"
)
ORACLE["validate_fit"] = L0 + (
    "SELECT pair_id, CAST(len(src_ids) AS INTEGER) AS src_len, CAST(len(tgt_ids) AS INTEGER) AS tgt_len "
    "FROM encoded WHERE NOT (len(src_ids) <= 158 AND len(tgt_ids) <= 159)"
)
ORACLE["truncate_ids"] = L0 + "SELECT pair_id, src_ids[1:158] AS src_ids FROM encoded"
ORACLE["next_token_pairs"] = L0 + (
    "SELECT pair_id, CAST(i - 1 AS INTEGER) AS pos, s[i] AS prev, s[i + 1] AS next FROM "
    "(SELECT pair_id, s, unnest(range(1, len(s))) AS i FROM "
    "(SELECT pair_id, [5]::INTEGER[] || tgt_ids || [4]::INTEGER[] AS s FROM fit))"
)
ORACLE["ngrams"] = L0 + (
    "SELECT pair_id, CASE WHEN len(tgt_ids) >= 3 THEN list_transform(range(1, len(tgt_ids) - 1), "
    "lambda i: tgt_ids[i:i + 2]) ELSE [] END AS grams FROM fit"
)


# ----------------------------------------------------------------- BLEU twins
HYPREF = f"""hyp_ref AS (
  SELECT pair_id, array_to_string(list_filter(regexp_extract_all(tgt, '{WORD}'), lambda w, i: i % 7 <> 0), ' ') AS hyp,
         tgt AS ref
  FROM pairs WHERE tgt <> '')"""


def tok13a(x: str) -> str:
    s = x
    for old, new in (("<skipped>", ""), ("-' || chr(10) || '", ""), ("' || chr(10) || '", " "),
                     ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = f"replace({s}, '{old}', '{new}')"
    s = f"(' ' || {s} || ' ')"
    steps = (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
        (r"([^0-9])([\.,])", r"\1 \2 "),
        (r"([\.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    )
    for pat, rep in steps:
        s = f"regexp_replace({s}, '{pat}', '{rep}', 'g')"
    return f"regexp_extract_all({s}, '{WORD}')"


TOK = f"""tk AS MATERIALIZED (SELECT pair_id, {tok13a('hyp')} AS hyp_tokens, {tok13a('ref')} AS ref_tokens FROM hyp_ref)"""


def grams_sql(x: str, n: int) -> str:
    return (f"CASE WHEN len({x}) >= {n} THEN list_transform(range(1, len({x}) - {n - 2}), "
            f"lambda i: array_to_string({x}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END")


def matches_ctes(tk: str = "tk", key: str = "pair_id", by: str = "") -> list[str]:
    b = f"{by}, " if by else ""
    parts = []
    for n in range(1, 5):
        parts.append(f"SELECT {key}, {b}{n} AS n, unnest({grams_sql('hyp_tokens', n)}) AS g, 1 AS h FROM {tk}")
        parts.append(f"SELECT {key}, {b}{n} AS n, unnest({grams_sql('ref_tokens', n)}) AS g, 0 AS h FROM {tk}")
    return [
        f"gc AS (SELECT {key}, {b}n, g, sum(h) AS hc, sum(1 - h) AS rc FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)",
        f"per AS (SELECT {key}, {b}n, CAST(sum(least(hc, rc)) AS BIGINT) AS matches, CAST(sum(hc) AS BIGINT) AS total FROM gc GROUP BY ALL)",
        f"nm AS MATERIALIZED (SELECT l.{key}, {''.join(f'l.{c.strip()}, ' for c in by.split(',') if c.strip())}CAST(l.n AS INTEGER) AS n, "
        f"coalesce(p.matches, 0)::BIGINT AS matches, coalesce(p.total, 0)::BIGINT AS total, l.hyp_len, l.ref_len FROM "
        f"(SELECT {key}, {b}CAST(len(hyp_tokens) AS BIGINT) AS hyp_len, CAST(len(ref_tokens) AS BIGINT) AS ref_len, unnest(range(1, 5)) AS n FROM {tk}) l "
        f"LEFT JOIN per p ON p.{key} = l.{key} AND p.n = l.n)",
    ]


def bleu_select(by: str = "") -> str:
    b = f"{by}, " if by else ""
    sums = ", ".join(
        f"CAST(sum(CASE WHEN n = {n} THEN matches ELSE 0 END) AS BIGINT) AS m{n}, "
        f"CAST(sum(CASE WHEN n = {n} THEN total ELSE 0 END) AS BIGINT) AS t{n}" for n in range(1, 5)
    )
    s = (f"SELECT {b}{sums}, CAST(sum(CASE WHEN n = 1 THEN hyp_len ELSE 0 END) AS BIGINT) AS sys_len, "
         f"CAST(sum(CASE WHEN n = 1 THEN ref_len ELSE 0 END) AS BIGINT) AS ref_len FROM nm" + (f" GROUP BY {by}" if by else ""))
    z = ["(CASE WHEN m1 = 0 THEN 1 ELSE 0 END)"]
    for n in range(2, 5):
        z.append(f"({z[-1]} + CASE WHEN m{n} = 0 THEN 1 ELSE 0 END)")
    logs = [f"ln(CASE WHEN m{n} > 0 THEN 100.0 * m{n} / t{n} ELSE 100.0 / (pow(2.0, {z[n - 1]}) * t{n}) END)" for n in range(1, 5)]
    bleu = (f"CASE WHEN m1 + m2 + m3 + m4 = 0 OR t1 = 0 OR t2 = 0 OR t3 = 0 OR t4 = 0 THEN 0.0 ELSE "
            f"(CASE WHEN sys_len > ref_len THEN 1.0 WHEN sys_len > 0 THEN exp(1 - ref_len / sys_len) ELSE 0.0 END) * "
            f"exp(({' + '.join(logs)}) / 4) END")
    return (f"SELECT {b}round({bleu}, 6) AS bleu, sys_len, ref_len, m1, m2, m3, m4, t1, t2, t3, t4 FROM ({s})")


ORACLE["bleu_tokenize"] = w(PAIRS, HYPREF, TOK) + "SELECT * FROM tk"
ORACLE["ngram_matches"] = w(PAIRS, HYPREF, TOK, *matches_ctes()) + "SELECT * FROM nm"
ORACLE["corpus_bleu"] = w(PAIRS, HYPREF, TOK, *matches_ctes()) + bleu_select()
TOKL = f"""tkl AS MATERIALIZED (SELECT h.pair_id, d.lang, {tok13a('hyp')} AS hyp_tokens, {tok13a('ref')} AS ref_tokens
  FROM hyp_ref h JOIN documents d ON d.doc_id = h.pair_id // 100000)"""
ORACLE["grouped_bleu"] = w(PAIRS, HYPREF, TOKL, *matches_ctes("tkl", by="lang")) + bleu_select("lang")


# ----------------------------------------------------------------- vector twins
def rd(x: str, k: int = 6) -> str:
    """Round like Spark (and turn -0.0 into 0.0)."""
    return f"(round({x}, {k}) + 0.0)"


def rda(x: str) -> str:
    return f"list_transform({x}, lambda y: {rd('y')})"


VECS = """vecs AS (SELECT CAST(vec_id // 12 AS BIGINT) AS seq_id, CAST(vec_id % 12 AS INTEGER) AS pos, vec_id, label,
  CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"""
LOGITS = "lg AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS logits, label FROM embeddings)"


def dot_sql(a: str, b: str) -> str:
    return f"list_sum(list_transform({a}, lambda x, i: x * {b}[i]))"


def pe_sql(p: str) -> str:
    k = "(-ln(10000.0) / 64)"
    return (f"list_transform(range(64), lambda i: CASE WHEN i % 2 = 0 THEN sin({p} * exp((i - i % 2) * {k})) "
            f"ELSE cos({p} * exp((i - i % 2) * {k})) END)")


def layer_norm_sql(v: str) -> str:
    mu = f"(list_sum({v}) / len({v}))"
    sd = f"sqrt(list_sum(list_transform({v}, lambda x: (x - {mu}) * (x - {mu}))) / len({v}))"
    return f"list_transform({v}, lambda x: 1.0 * (x - {mu}) / ({sd} + 1e-6) + 0.0)"


def weights_py(n_out: int, n_in: int, salt: int = 0):
    w = [[(((o * 31 + i * 17 + salt) % 13) - 6) / 13.0 for i in range(n_in)] for o in range(n_out)]
    b = [((o % 5) - 2) / 10.0 for o in range(n_out)]
    return w, b


def linear_sql(x: str, n_out: int, n_in: int, salt: int = 0) -> str:
    w, b = weights_py(n_out, n_in, salt)
    outs = []
    for o in range(n_out):
        wl = "[" + ", ".join(repr(t) + "::DOUBLE" for t in w[o]) + "]"
        outs.append(f"({dot_sql(wl, x)} + {b[o]!r})")
    return "[" + ", ".join(outs) + "]"


HEADS = """hq AS (SELECT seq_id, CAST(head AS INTEGER) AS head, pos, vec[head * 8 + 1:head * 8 + 8] AS x
  FROM (SELECT seq_id, pos, vec, unnest(range(8)) AS head FROM vecs))"""


def attn_ctes(mask: str, kv: str = "hq", pre: str = "") -> list[str]:
    cond = {"none": "", "causal": " AND k.pos <= q.pos", "valid": " AND k.pos < vl.valid_len"}[mask]
    join_valid = " JOIN vl ON vl.seq_id = q.seq_id" if mask == "valid" else ""
    return [
        f"{pre}sc AS (SELECT q.seq_id, q.head, q.pos AS row, k.pos AS column, {dot_sql('q.x', 'k.x')} / sqrt(8) AS score, "
        f"k.x AS v FROM hq q JOIN {kv} k ON k.seq_id = q.seq_id AND k.head = q.head{join_valid} WHERE true{cond})",
        f"{pre}ex AS (SELECT *, exp(score - max(score) OVER (PARTITION BY seq_id, head, row)) AS e FROM {pre}sc)",
        f"{pre}wt AS MATERIALIZED (SELECT seq_id, head, row, \"column\", v, e / sum(e) OVER (PARTITION BY seq_id, head, row) AS weight FROM {pre}ex)",
        f"{pre}ot AS (SELECT seq_id, head, row, list(s ORDER BY dim) AS out FROM (SELECT seq_id, head, row, dim, sum(weight * v[dim]) AS s "
        f"FROM (SELECT seq_id, head, row, weight, v, unnest(range(1, 9)) AS dim FROM {pre}wt) GROUP BY ALL) GROUP BY ALL)",
    ]


ORACLE["embed_scale"] = w(VECS) + (
    f"SELECT t.seq_id, t.pos, {rda('list_transform(e.vec, lambda x: x * 8.0)')} AS emb "
    "FROM vecs t JOIN vecs e ON e.vec_id = t.vec_id"
)
ORACLE["positional_table"] = w(VECS) + (
    f"SELECT pos, {rda(pe_sql('pos'))} AS pe FROM (SELECT DISTINCT pos FROM vecs)"
)
ORACLE["add_positional"] = w(VECS) + (
    f"SELECT seq_id, pos, {rda(f'list_transform(vec, lambda x, i: x + pe[i])')} AS vec FROM "
    f"(SELECT v.*, p.pe FROM vecs v JOIN (SELECT pos, {pe_sql('pos')} AS pe FROM (SELECT DISTINCT pos FROM vecs)) p USING (pos))"
)
ORACLE["layer_norm"] = w(VECS) + f"SELECT vec_id, {rda(layer_norm_sql('vec'))} AS vec FROM vecs"
ORACLE["linear"] = w(VECS) + f"SELECT vec_id, {rda(linear_sql('vec', 8, 64))} AS out FROM vecs"
ORACLE["feed_forward"] = w(VECS) + (
    f"SELECT vec_id, {rda(linear_sql('h', 64, 16, 5))} AS out FROM "
    f"(SELECT vec_id, list_transform({linear_sql('vec', 16, 64)}, lambda x: greatest(x, 0.0)) AS h FROM vecs)"
)
ORACLE["split_heads"] = w(VECS) + (
    f"SELECT vec_id, list_transform(range(8), lambda i: {rda('vec[i * 8 + 1:i * 8 + 8]')}) AS heads FROM vecs"
)
ORACLE["attention_scores"] = w(VECS, HEADS) + (
    f"SELECT q.seq_id, q.head, q.pos AS row, k.pos AS column, {rd(dot_sql('q.x', 'k.x') + ' / sqrt(8)')} AS score "
    "FROM hq q JOIN hq k ON k.seq_id = q.seq_id AND k.head = q.head"
)
MERGED = "SELECT seq_id, row AS pos, " + rda("flatten(list(out ORDER BY head))") + " AS vec FROM ot GROUP BY seq_id, row"
ORACLE["attention_self"] = w(VECS, HEADS, *attn_ctes("none")) + MERGED
ORACLE["attention_causal"] = w(VECS, HEADS, *attn_ctes("causal")) + MERGED
SRCV = f"""srcv AS (SELECT seq_id, pos, {layer_norm_sql('vec')} AS vec FROM vecs),
hk AS (SELECT seq_id, CAST(head AS INTEGER) AS head, pos, vec[head * 8 + 1:head * 8 + 8] AS x
  FROM (SELECT seq_id, pos, vec, unnest(range(8)) AS head FROM srcv)),
vl AS (SELECT seq_id, CAST(count(*) FILTER (WHERE label <> 1) AS INTEGER) AS valid_len FROM vecs GROUP BY seq_id)"""
ORACLE["attention_cross"] = w(VECS, HEADS, SRCV, *attn_ctes("valid", "hk")) + MERGED


def log_softmax_sql(v: str) -> str:
    m = f"list_max({v})"
    lse = f"(ln(list_sum(list_transform({v}, lambda x: exp(x - {m})))) + {m})"
    return f"list_transform({v}, lambda x: x - {lse})"


ORACLE["softmax"] = w(LOGITS) + (
    f"SELECT vec_id, {rda('list_transform(e, lambda x: x / list_sum(e))')} AS p FROM "
    "(SELECT vec_id, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM lg)"
)
ORACLE["log_softmax"] = w(LOGITS) + f"SELECT vec_id, {rda(log_softmax_sql('logits'))} AS logp FROM lg"
ORACLE["smoothed_ce"] = w(LOGITS) + (
    f"SELECT {rd('avg(0.9 * (-lp[label + 1]) + 0.1 * (-list_sum(lp) / len(lp)))')} AS loss, CAST(count(*) AS BIGINT) AS rows "
    f"FROM (SELECT label, {log_softmax_sql('logits')} AS lp FROM lg WHERE label <> 1)"
)
METRICS = """metrics AS (SELECT 'Loss/train' AS tag, CAST(r + 1 AS BIGINT) AS step, CAST(r // 500 AS BIGINT) AS epoch,
  CAST(value AS DOUBLE) AS value FROM (
  SELECT value, row_number() OVER (ORDER BY ts, event_id) - 1 AS r FROM events WHERE event_type = 'view'))"""
ORACLE["lr_schedule"] = w(METRICS) + (
    "SELECT step, round(0.0003 * least(CAST(step AS DOUBLE) / 4000.0, sqrt(4000.0 / CAST(step AS DOUBLE))), 12) + 0.0 AS lr FROM metrics"
)
ORACLE["length_penalty"] = w(PAIRS) + (
    f"SELECT pair_id, CAST({wc('tgt')} + 2 AS INTEGER) AS len, {rd(f'pow((5.0 + ({wc('tgt')} + 2)) / 6.0, 0.6)')} AS lp "
    f"FROM pairs WHERE {wc('src')} BETWEEN 1 AND 40 AND {wc('tgt')} BETWEEN 1 AND 40"
)


# ----------------------------------------------------------------- decoding twins
BIGRAM = f"""bg AS MATERIALIZED (
  SELECT prev, token, cnt, ln(cnt / sum(cnt) OVER (PARTITION BY prev)) AS logp FROM (
    SELECT s[i] AS prev, s[i + 1] AS token, count(*) AS cnt FROM (
      SELECT s, unnest(range(1, len(s))) AS i FROM (
        SELECT ['[SOS]'] || regexp_extract_all(tgt, '{PRETOK}') || ['[EOS]'] AS s FROM kept WHERE split = 'train'))
    GROUP BY 1, 2)),
ranked AS MATERIALIZED (SELECT *, round(logp, 9) AS logp9, row_number() OVER (PARTITION BY prev ORDER BY cnt DESC, token) AS succ_rank FROM bg)"""
SEEDS = f"""seeds AS (SELECT pair_id AS sent_id, ['[SOS]', regexp_extract_all(src, '{PRETOK}')[1]] AS tokens
  FROM kept WHERE split = 'val')"""


def banned_sql(s: str, n: int) -> str:
    return (f"CASE WHEN {n} <= 0 OR len({s}) < {n} THEN []::VARCHAR[] ELSE list_distinct(list_transform("
            f"list_filter(range(1, len({s}) - {n} + 2), lambda i: {s}[i:i + {n} - 2] = {s}[len({s}) - {n} + 2:len({s})]), "
            f"lambda i: {s}[i + {n} - 1])) END")


D0 = w(PAIRS, PREP, BIGRAM)
ORACLE["score_table"] = D0 + f"SELECT prev, token, cnt, {rd('logp')} AS logp FROM bg"
ORACLE["argmax_token"] = D0 + "SELECT prev, token FROM ranked WHERE succ_rank = 1"
GREEDY = """g AS (
  SELECT sent_id, tokens, false AS done FROM seeds
  UNION ALL
  SELECT g.sent_id, list_append(g.tokens, b.token), b.token = '[EOS]' FROM g JOIN ranked b ON b.prev = g.tokens[-1] AND b.succ_rank = 1
  WHERE NOT g.done AND len(g.tokens) < 160),
greedy AS (SELECT sent_id, arg_max(tokens, len(tokens)) AS tokens FROM g GROUP BY sent_id)"""
ORACLE["greedy_decode"] = "WITH RECURSIVE " + ",\n".join([PAIRS, PREP, BIGRAM, SEEDS, GREEDY]) + "\nSELECT sent_id, tokens FROM greedy"
ORACLE["repeat_rate"] = "WITH RECURSIVE " + ",\n".join([PAIRS, PREP, BIGRAM, SEEDS, GREEDY]) + (
    "\nSELECT " + rd("avg(CASE WHEN len(list_distinct(gr)) < len(gr) THEN 1.0 ELSE 0.0 END)") + " AS rate, "
    "CAST(count(*) AS BIGINT) AS rows FROM (SELECT CASE WHEN len(tokens) >= 3 THEN list_transform(range(1, len(tokens) - 1), "
    "lambda i: tokens[i:i + 2]) ELSE [] END AS gr FROM greedy)"
)
ORACLE["ngram_block"] = w(PAIRS, PREP) + (
    f"SELECT pair_id, list_sort({banned_sql('s', 3)}) AS banned FROM "
    f"(SELECT pair_id, ['[SOS]'] || regexp_extract_all(tgt, '{PRETOK}') AS s FROM kept)"
)
EXPAND = f"""cand AS MATERIALIZED (
  SELECT s.sent_id, 0 AS beam, s.tokens, r.token, 0.0 + r.logp9 AS cs FROM seeds s
  JOIN ranked r ON r.prev = s.tokens[-1] AND r.succ_rank <= 173 AND r.succ_rank <= 2 * 4 + len({banned_sql('s.tokens', 3)}) + 1
  WHERE NOT (len(s.tokens) = 1 AND r.token = '[EOS]') AND NOT list_contains({banned_sql('s.tokens', 3)}, r.token)),
sp AS MATERIALIZED (SELECT *, coalesce(sum(CASE WHEN NOT is_eos THEN 1 ELSE 0 END) OVER (PARTITION BY sent_id ORDER BY rk
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS alive_before FROM (
  SELECT *, token = '[EOS]' AS is_eos FROM (
    SELECT *, row_number() OVER (PARTITION BY sent_id ORDER BY cs DESC, beam, token) AS rk FROM cand) WHERE rk <= 8))"""
D1 = w(PAIRS, PREP, BIGRAM, SEEDS, EXPAND)
ORACLE["beam_expand"] = D1 + f"SELECT sent_id, beam, token, {rd('cs')} AS cs FROM cand"
ORACLE["beam_split"] = D1 + (
    f"SELECT sent_id, CAST(rk AS INTEGER) AS rk, token, is_eos, CAST(alive_before AS INTEGER) AS alive_before, {rd('cs')} AS cs "
    "FROM sp WHERE alive_before < 4"
)
STEP = """nx AS MATERIALIZED (SELECT sent_id, CAST(alive_before AS INTEGER) AS beam, list_append(tokens, token) AS tokens, cs AS score FROM (
  SELECT *, sum(CASE WHEN is_eos THEN 1 ELSE 0 END) OVER (PARTITION BY sent_id) AS total_fin FROM sp WHERE alive_before < 4)
  WHERE NOT is_eos AND total_fin < 4)"""
D2 = w(PAIRS, PREP, BIGRAM, SEEDS, EXPAND, STEP)
ORACLE["beam_step"] = D2 + f"SELECT sent_id, beam, tokens, {rd('score')} AS score FROM nx"
ORACLE["topk_candidates"] = D2 + (
    f"SELECT sent_id, CAST(rk AS INTEGER) AS rk, beam, token, {rd('cs')} AS cs FROM ("
    "SELECT *, row_number() OVER (PARTITION BY sent_id ORDER BY cs DESC, beam, token) AS rk FROM ("
    "SELECT s.sent_id, s.beam, r.token, s.score + r.logp9 AS cs FROM nx s JOIN ranked r ON r.prev = s.tokens[-1] "
    f"AND r.succ_rank <= 2 * 4 + len({banned_sql('s.tokens', 3)}) + 1 "
    f"WHERE NOT list_contains({banned_sql('s.tokens', 3)}, r.token))) WHERE rk <= 8"
)
GRID = ("(VALUES (0, 1, 0, 0.6), (1, 1, 3, 0.6), (2, 2, 0, 0.6), (3, 2, 3, 0.6), (4, 4, 0, 0.6), (5, 4, 3, 0.6), "
        "(6, 6, 0, 0.6), (7, 6, 3, 0.6), (8, 4, 3, 0.0), (9, 4, 3, 0.6), (10, 4, 3, 1.0)) AS g(cfg, k, ngram, alpha)")
ORACLE["cross_param_grid"] = w(PAIRS, PREP) + (
    "SELECT CAST(g.cfg AS INTEGER) AS cfg, k.pair_id AS sent_id, CAST(g.k AS INTEGER) AS k, CAST(g.ngram AS INTEGER) AS ngram, "
    f"CAST(g.alpha AS DOUBLE) AS alpha FROM kept k, {GRID} WHERE k.split = 'val'"
)




def beam_cte(max_len: int = 160) -> str:
    """Beam search of ``bseeds(cfg, sent_id, tokens, k, ngram, alpha)`` over ``ranked``: one
    round per recursion; ``beams`` holds every alive and finished hypothesis."""
    return f"""beams AS (
  SELECT cfg, sent_id, k, ngram, alpha, tokens, 0.0::DOUBLE AS score, 0 AS beam, 0 AS nfin, 'alive' AS kind,
         NULL::DOUBLE AS norm, 0 AS step, 0 AS rk FROM bseeds
  UNION ALL
  (WITH a AS (SELECT *, {banned_sql('tokens', 'ngram')} AS ban FROM beams WHERE kind = 'alive'),
  c AS (SELECT a.*, r.token, a.score + r.logp9 AS cs FROM a JOIN ranked r
        ON r.prev = a.tokens[-1] AND r.succ_rank <= 2 * a.k + len(a.ban) + 1
        WHERE len(a.tokens) < {max_len} AND NOT (len(a.tokens) = 1 AND r.token = '[EOS]') AND NOT list_contains(a.ban, r.token)),
  o AS (SELECT *, row_number() OVER (PARTITION BY cfg, sent_id ORDER BY cs DESC, beam, token) AS pos FROM c),
  e AS (SELECT *, coalesce(sum(CASE WHEN token <> '[EOS]' THEN 1 ELSE 0 END) OVER (PARTITION BY cfg, sent_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM o WHERE pos <= 2 * k),
  p AS (SELECT *, nfin + sum(CASE WHEN token = '[EOS]' THEN 1 ELSE 0 END) OVER (PARTITION BY cfg, sent_id) AS fins FROM e WHERE ahead < k)
  SELECT cfg, sent_id, k, ngram, alpha, list_append(tokens, token), cs, CAST(ahead AS INTEGER), CAST(fins AS INTEGER), 'alive',
         NULL::DOUBLE, step + 1, 0 FROM p WHERE token <> '[EOS]' AND fins < k
  UNION ALL
  SELECT cfg, sent_id, k, ngram, alpha, list_append(tokens, token), cs, 0, 0, 'done',
         cs / pow((5.0 + len(tokens) + 1) / 6.0, alpha), step + 1, CAST(pos AS INTEGER) FROM p WHERE token = '[EOS]'
  UNION ALL
  SELECT cfg, sent_id, k, ngram, alpha, tokens, score, 0, 0, 'done', score / pow((5.0 + len(tokens)) / 6.0, alpha), step + 1, 0
  FROM a WHERE beam = 0 AND nfin = 0 AND NOT EXISTS (SELECT 1 FROM p WHERE p.cfg = a.cfg AND p.sent_id = a.sent_id))),
beamed AS (SELECT cfg, sent_id, tokens, norm FROM beams WHERE kind = 'done'
  QUALIFY row_number() OVER (PARTITION BY cfg, sent_id ORDER BY norm DESC, step, rk) = 1)"""


def hyp_text(tokens: str) -> str:
    return detok_sql(f"array_to_string(list_filter({tokens}, lambda t: t NOT IN ('[SOS]', '[EOS]')), ' ')")


ONE = "bseeds AS (SELECT 0 AS cfg, sent_id, tokens, 4 AS k, 3 AS ngram, 0.6::DOUBLE AS alpha FROM seeds)"
R0 = "WITH RECURSIVE " + ",\n".join([PAIRS, PREP, BIGRAM, SEEDS, ONE, beam_cte(), GREEDY])
ORACLE["beam_decode"] = R0 + f"\nSELECT sent_id, tokens, {rd('norm')} AS norm FROM beamed"
ORACLE["compare_methods"] = R0 + (
    f"\nSELECT s.sent_id, k.src AS source, k.tgt AS target, {hyp_text('g.tokens')} AS greedy, {hyp_text('b.tokens')} AS beam "
    "FROM (SELECT sent_id FROM seeds ORDER BY sent_id LIMIT 5) s JOIN kept k ON k.pair_id = s.sent_id "
    "JOIN greedy g ON g.sent_id = s.sent_id JOIN beamed b ON b.sent_id = s.sent_id"
)
SWEEP = [
    f"bseeds AS (SELECT CAST(g.cfg AS INTEGER) AS cfg, s.sent_id, s.tokens, g.k, g.ngram, g.alpha::DOUBLE AS alpha FROM seeds s, {GRID})",
    beam_cte(), GREEDY,
    "hyps AS (SELECT cfg, sent_id, tokens FROM beamed UNION ALL SELECT -1, sent_id, tokens FROM greedy)",
    f"hr AS MATERIALIZED (SELECT h.cfg || ':' || h.sent_id AS hid, h.cfg, {hyp_text('h.tokens')} AS hyp, k.tgt AS ref "
    "FROM hyps h JOIN kept k ON k.pair_id = h.sent_id)",
    f"tk AS MATERIALIZED (SELECT hid, cfg, {tok13a('hyp')} AS hyp_tokens, {tok13a('ref')} AS ref_tokens FROM hr)",
    *matches_ctes("tk", key="hid", by="cfg"),
    f"scored AS ({bleu_select('cfg')})",
]
ORACLE["bleu_sweep"] = "WITH RECURSIVE " + ",\n".join([PAIRS, PREP, BIGRAM, SEEDS, *SWEEP]) + (
    "\nSELECT CAST(s.cfg AS INTEGER) AS cfg, CASE WHEN s.cfg = -1 THEN 'greedy' ELSE 'beam' END AS method, "
    "CAST(coalesce(g.k, 1) AS INTEGER) AS k, CAST(coalesce(g.ngram, 0) AS INTEGER) AS ngram, "
    f"CAST(coalesce(g.alpha, 0.0) AS DOUBLE) AS alpha, s.bleu FROM scored s LEFT JOIN {GRID} ON g.cfg = s.cfg"
)
SUBWORD = [
    "tv AS MATERIALIZED (SELECT list(token ORDER BY id) AS names FROM t_vocab)",
    "sv AS MATERIALIZED (SELECT list(token ORDER BY id) AS names FROM s_vocab)",
    BIGRAM.replace(
        f"['[SOS]'] || regexp_extract_all(tgt, '{PRETOK}') || ['[EOS]'] AS s FROM kept WHERE",
        "['[SOS]'] || list_transform(tgt_ids, lambda i: names[i + 1]) || ['[EOS]'] AS s FROM encoded, tv WHERE"),
    "first AS (SELECT pair_id AS sent_id, src, sv.names[src_ids[1] + 1] AS token, tv.names AS known FROM encoded, sv, tv WHERE split = 'val')",
    "bseeds AS (SELECT 0 AS cfg, sent_id, ['[SOS]', CASE WHEN list_contains(known, token) THEN token ELSE '[UNK]' END] AS tokens, "
    "4 AS k, 3 AS ngram, 0.6::DOUBLE AS alpha FROM first)",
    beam_cte(),
]
SPECIAL_LIST = "('[UNK]', '[PAD]', '[CLS]', '[SEP]', '[EOS]', '[SOS]', '[BOS]', '[MASK]')"
SUBWORD_TEXT = f"replace(array_to_string(list_filter(b.tokens, lambda t: t NOT IN {SPECIAL_LIST}), ''), '</w>', ' ')"
ORACLE["translate_batch"] = "WITH RECURSIVE " + ",\n".join([PAIRS, PREP, *ENC2, *SUBWORD]) + (
    f"\nSELECT f.sent_id, {wc('f.src')} > 40 AS over_length, {detok_sql(strip(SUBWORD_TEXT))} AS text "
    "FROM beamed b JOIN first f ON f.sent_id = b.sent_id"
)
ORACLE["roundtrip"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M), KEPT_SRC, *encode_ctes("kept_src", M)) + (
    f"SELECT {rd('avg(CASE WHEN back = want THEN 1.0 ELSE 0.0 END)')} AS rate, CAST(count(*) AS BIGINT) AS rows FROM ("
    f"SELECT {detok_sql(strip("replace(coalesce(d.t, ''), '</w>', ' ')"))} AS back, "
    f"{detok_sql(f"array_to_string(regexp_extract_all(k.src, '{PRETOK}'), ' ')")} AS want "
    "FROM kept k LEFT JOIN (SELECT e.pair_id, string_agg(v.token, '' ORDER BY e.i, e.j) AS t "
    "FROM enc_sym e JOIN vocab v ON v.id = e.id WHERE e.id >= 8 GROUP BY e.pair_id) d USING (pair_id))"
)


# ----------------------------------------------------------------- metrics, stores, attention analysis, stream
ORACLE["metric_log"] = w(METRICS) + "SELECT tag, step, value FROM metrics WHERE step % 50 = 0"
ORACLE["epoch_loss"] = w(METRICS) + (
    f"SELECT epoch, {rd('avg(value)')} AS loss, CAST(count(*) AS BIGINT) AS steps FROM metrics GROUP BY epoch"
)
ORACLE["running_loss"] = w(METRICS) + (
    "SELECT step, epoch, CAST((s * 20000 + n) // (2 * n) AS BIGINT) / 1e6 AS running_loss FROM ("
    "SELECT step, epoch, sum(CAST(round(value * 100) AS BIGINT)) OVER w AS s, count(*) OVER w AS n FROM metrics "
    "WINDOW w AS (PARTITION BY epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
)
ORACLE["batch_loss_mean"] = w(LOGITS) + (
    f"SELECT {rd('avg(bl)')} AS loss, CAST(count(*) AS BIGINT) AS batches FROM ("
    "SELECT batch_id, avg(0.9 * (-lp[label + 1]) + 0.1 * (-list_sum(lp) / len(lp))) AS bl FROM ("
    f"SELECT label, {log_softmax_sql('logits')} AS lp, (row_number() OVER (ORDER BY vec_id) - 1) // 64 AS batch_id FROM lg) "
    "WHERE label <> 1 AND batch_id < 100 GROUP BY batch_id)"
)
ORACLE["corpus_stats"] = L0 + (
    f"SELECT split, CAST(count(*) AS BIGINT) AS pairs, CAST(sum({wc('src')}) AS BIGINT) AS src_words, "
    f"CAST(sum({wc('tgt')}) AS BIGINT) AS tgt_words, CAST(max({wc('src')}) AS INTEGER) AS max_src_words, "
    f"CAST(max({wc('tgt')}) AS INTEGER) AS max_tgt_words, {rd(f"avg({wc('src')})")} AS avg_src_words, "
    "CAST(sum(len(src_ids)) AS BIGINT) AS src_tokens, CAST(sum(len(tgt_ids)) AS BIGINT) AS tgt_tokens, "
    "CAST(max(len(src_ids)) AS INTEGER) AS max_src_tokens, CAST(max(len(tgt_ids)) AS INTEGER) AS max_tgt_tokens "
    "FROM encoded GROUP BY split"
)
ORACLE["vocab_lookup"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M)) + (
    "SELECT o.pair_id, CAST(o.pos AS INTEGER) AS pos, o.token, CAST(coalesce(v.id, 0) AS INTEGER) AS id, "
    "coalesce(b.token, '<blank>') AS back FROM ("
    f"SELECT pair_id, unnest(a) AS token, unnest(range(len(a))) AS pos FROM (SELECT pair_id, regexp_extract_all(src, '{PRETOK}') AS a FROM kept)) o "
    "LEFT JOIN vocab v ON v.token = o.token LEFT JOIN vocab b ON b.id = coalesce(v.id, 0)"
)
ORACLE["vocab_store"] = w(PAIRS, PREP, *bpe_ctes(TRAIN_SRC, M)) + "SELECT token, id FROM vocab"
ORACLE["snapshot_write"] = w(METRICS) + (
    "SELECT 2 AS version, CAST(count(DISTINCT epoch) AS BIGINT) AS rows FROM metrics WHERE epoch <= 2"
)
ORACLE["snapshot_read"] = ORACLE["epoch_loss"]
ORACLE["metric_stream"] = ORACLE["epoch_loss"]
ATT = w(VECS, HEADS, SRCV, *attn_ctes("none", "hq", "e_"), *attn_ctes("causal", "hq", "d_"),
        *attn_ctes("valid", "hk", "c_"),
        "attn AS MATERIALIZED (SELECT seq_id, 'encoder' AS type, 0 AS layer, head, row, \"column\", weight AS value FROM e_wt "
        "UNION ALL SELECT seq_id, 'decoder', 0, head, row, \"column\", weight FROM d_wt "
        "UNION ALL SELECT seq_id, 'cross', 0, head, row, \"column\", weight FROM c_wt)",
        "toks AS (SELECT v.seq_id, v.pos, 'v' || v.vec_id AS token FROM vecs v "
        "JOIN (SELECT seq_id, max(pos) AS last FROM vecs GROUP BY seq_id) l ON l.seq_id = v.seq_id WHERE v.pos < l.last)")
ORACLE["attn_long"] = ATT + (
    f"SELECT a.seq_id, a.head, a.row, a.\"column\", {rd('a.value')} AS value, "
    "printf('%03d %s', a.row, coalesce(r.token, '<blank>')) AS row_token, "
    "printf('%03d %s', a.\"column\", coalesce(c.token, '<blank>')) AS col_token FROM attn a "
    "LEFT JOIN toks r ON r.seq_id = a.seq_id AND r.pos = a.row LEFT JOIN toks c ON c.seq_id = a.seq_id AND c.pos = a.\"column\" "
    "WHERE a.type = 'cross' AND a.row < 20 AND a.\"column\" < 20"
)
ORACLE["attn_select"] = ATT + (
    f"SELECT seq_id, head, row, \"column\", {rd('value')} AS value FROM attn "
    "WHERE type = 'decoder' AND layer IN (0) AND head IN (0, 1, 2)"
)
ORACLE["attn_entropy"] = ATT + (
    f"SELECT type, CAST(layer AS INTEGER) AS layer, {rd('avg(h)')} AS entropy, CAST(count(*) AS BIGINT) AS heads FROM ("
    "SELECT type, layer, head, avg(h) AS h FROM (SELECT seq_id, type, layer, head, row, "
    "sum(CASE WHEN value > 0 THEN -value * ln(value) ELSE 0.0 END) AS h FROM attn GROUP BY ALL) GROUP BY ALL) GROUP BY ALL"
)
ORACLE["attn_sink"] = ATT + (
    f"SELECT type, CAST(layer AS INTEGER) AS layer, head, {rd('avg(peak)')} AS mean_peak, "
    f"{rd('avg(CASE WHEN peak_col = 0 THEN 1.0 ELSE 0.0 END)')} AS sink_share FROM ("
    "SELECT seq_id, type, layer, head, row, max(value) AS peak, "
    "arg_max(\"column\", value * 1e0) FILTER (WHERE true) AS peak_col0, "
    "min(\"column\") FILTER (WHERE value = mx) AS peak_col FROM "
    "(SELECT *, max(value) OVER (PARTITION BY seq_id, type, layer, head, row) AS mx FROM attn) GROUP BY ALL) GROUP BY ALL"
)
ORACLE["attn_align"] = ATT + (
    "SELECT seq_id, head, row, CAST(min(\"column\") FILTER (WHERE value = mx) AS INTEGER) AS best_column FROM "
    "(SELECT *, max(value) OVER (PARTITION BY seq_id, type, layer, head, row) AS mx FROM attn WHERE type = 'cross') "
    "GROUP BY seq_id, head, row"
)
ORACLE["attn_valid"] = ATT + (
    f"SELECT a.seq_id, a.head, a.row, a.\"column\", {rd('a.value')} AS value FROM attn a JOIN vl ON vl.seq_id = a.seq_id "
    "WHERE a.type = 'encoder' AND a.\"column\" < vl.valid_len"
)
ORACLE["stream_prepare"] = L0 + (
    f"SELECT pair_id, {enc_in('src_ids')} AS encoder_input, {dec_in('tgt_ids')} AS decoder_input, {lab('tgt_ids')} AS labels FROM fit"
)
