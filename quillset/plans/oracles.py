"""ANSI SQL for the queries, over the given tables as views. Each statement is written from the definition of the
operator, not from its Spark plan."""

from __future__ import annotations

from quillset.functions.fixed_values import (
    ANSWER_PREFIX,
    CHOICE_PROMPT_END,
    CHOICE_PROMPT_OPTIONS,
    ENTITY_LABELS,
    EXAM_PROMPT_END,
    EXAM_PROMPT_START,
    MASKED_LABEL,
    NULL_TOKENS,
    SPECIAL_TOKENS,
)
from quillset.functions.prompts import INSTRUCT_TEMPLATE
from quillset.functions.text import FOLD_EXPANSIONS, FOLD_FROM, FOLD_TO, STOPWORDS

SEED, VOCAB_SIZE, MAX_LEN, BLOCK, WIDTH = 42, 5000, 512, 2048, 4


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"


def _fold(text: str) -> str:
    for mark, plain in FOLD_EXPANSIONS.items():
        text = f"replace({text}, {_q(mark)}, {_q(plain)})"
    return f"translate({text}, {_q(FOLD_FROM)}, {_q(FOLD_TO)})"


def _joined(array: str) -> str:
    return f"array_to_string(list_transform({array}, lambda x: coalesce(cast(x as varchar), 'null')), ' ')"


def _round(value: str) -> str:
    return f"round({value}, 6) + 0.0::double"


def _with(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "


# ---------------------------------------------------------------- derived tables

_opt = "case when n > 0 then array_to_string(w[n + {a}:n + {b}], ' ') end"
MCQ = (
    f"mcq_words as (select doc_id, w, len(w) - 12 as n from (select doc_id, {_words('text')} as w from documents)), "
    "mcq as (select m.doc_id as id, case when n > 0 then array_to_string(w[1:n], ' ') end as question, "
    f"{_opt.format(a=1, b=3)} as opa, {_opt.format(a=4, b=6)} as opb, "
    f"{_opt.format(a=7, b=9)} as opc, {_opt.format(a=10, b=12)} as opd, "
    "cast(m.doc_id % 4 as int) as cop, case l.toxic when 1 then 'multi' when 0 then 'single' end as choice_type "
    "from mcq_words m left join labels l on l.doc_id = m.doc_id)"
)
CORRECT = "case cop when 0 then opa when 1 then opb when 2 then opc when 3 then opd end"
ANSWERED = (
    MCQ + ", mcq_answered as (select *, case id % 7 when 0 then cop || '.' "
    f"when 1 then 'Answer: ' || ({CORRECT}) when 2 then 'The answer is ' || ((cop + 1) % 4) when 3 then '10' "
    f"when 4 then 'none of these' when 5 then substr({CORRECT}, 2) else 'Option ' || cop || ' because' end as answer "
    "from mcq)"
)
PARSE = (
    "case when contains(answer, '0') then 0 when contains(answer, '1') then 1 when contains(answer, '2') then 2 "
    "when contains(answer, '3') then 3 else -1 end"
)
SINGLE = "choice_type is distinct from 'multi'"
PREDICTED = ANSWERED + f", predicted as (select *, {PARSE} as prediction from mcq_answered where {SINGLE})"
REVIEWS = (
    "reviews as (select d.doc_id as id, d.text as clean_text, case when l.quality is null then null "
    "when l.quality = 1 and l.toxic = 0 then 1.0::double when l.quality = 1 then 0.0::double else -1.0::double end "
    "as category from documents d left join labels l on l.doc_id = d.doc_id)"
)
KNOWN = (
    REVIEWS + ", known as (select id, clean_text, category, case category when -1 then 0 when 0 then 1 when 1 then 2 "
    "else cast(category as int) end as category_1 from reviews where category is not null and clean_text is not null)"
)
NER_ROWS = (
    f"ner_words as (select doc_id as sent_id, {_words('text')} as tokens from documents), "
    "ner_cells as (select sent_id, unnest(tokens) as token, generate_subscripts(tokens, 1) - 1 as pos from ner_words), "
    "ner_tags as (select sent_id, cast(pos as int) as pos, token, case when (sent_id * 7 + pos * 5) % 18 < 9 "
    "then cast((sent_id * 7 + pos * 5) % 18 as int) else 0 end as tag from ner_cells), "
    "ner_rows as (select *, case when (sent_id + pos) % 9 = 0 then (tag + 1) % 9 else tag end as pred, "
    f"case when pos % 10 = 9 then {MASKED_LABEL} else tag end as label from ner_tags)"
)
NAMES = "[" + ", ".join(_q(n) for n in ENTITY_LABELS) + "]"


def _spans(source: str, column: str, name: str) -> str:
    """Span tables by gaps and islands: {name}(sent, start, end, type) with the token's own positions."""
    return (
        f"{name}_t as (select sent_id as sent, pos, {NAMES}[{column} + 1] as tag from {source}), "
        f"{name}_l as (select *, lag(tag) over (partition by sent order by pos) as before from {name}_t), "
        f"{name}_s as (select *, sum(case when tag <> 'O' and (tag like 'B-%' or coalesce(before, 'O') = 'O' "
        f"or substr(before, 3) <> substr(tag, 3)) then 1 else 0 end) over (partition by sent order by pos) as g "
        f"from {name}_l), "
        f"{name} as (select sent, min(pos) as \"start\", max(pos) as \"end\", substr(min(tag), 3) as type "
        f"from (select sent, pos, g, tag from {name}_s where tag <> 'O') group by sent, g, substr(tag, 3))"
    )


RENUMBERED = (
    NER_ROWS + ", kept as (select sent_id, cast(row_number() over (partition by sent_id order by pos) - 1 as int) as pos, "
    f"pred, label from ner_rows where label <> {MASKED_LABEL})"
)


def _hash(key: str) -> str:
    return f"md5('{SEED}:' || {key}), {key}"


def _ranked(source: str, key: str) -> str:
    return f"select *, row_number() over (order by {_hash(key)}) as rk, count(*) over () as n from {source}"


def _two_way(source: str, key: str, share: float) -> str:
    return (
        f"(select *, case when rk <= ceil({share}::double * n) then 'test' else 'train' end as split "
        f"from ({_ranked(source, key)}))"
    )


def _three_way(source: str, key: str) -> str:
    return (
        "(select *, case when rk <= nt then 'test' when rk <= nt + ceil(0.1::double * (n - nt)) then 'validation' "
        f"else 'train' end as split from (select *, ceil(0.2::double * n) as nt from ({_ranked(source, key)})))"
    )


# ---------------------------------------------------------------- prompts

MCQ_PROMPT = (
    f"question || {_q(CHOICE_PROMPT_OPTIONS)} || opa || {_q(chr(10) + '1. ')} || opb || {_q(chr(10) + '2. ')} || opc || "
    f"{_q(chr(10) + '3. ')} || opd || {_q(CHOICE_PROMPT_END)}"
)


def _exam(options: list[str]) -> str:
    numbered = " || ".join(f"{_q(chr(10) + str(i + 1) + '. ')} || {o}" for i, o in enumerate(options))
    return (
        f"{_q(EXAM_PROMPT_START + chr(10) + 'Question: ')} || question || {_q(chr(10) + 'Options:')} || {numbered} || "
        f"{_q(chr(10) + EXAM_PROMPT_END)}"
    )


EXAM_PROMPT = _exam(["opa", "opb", "opc", "opd"])
_KEYED = ", ".join(
    "{'k': md5('" + f"{SEED}:' || id || ':{i}'), 'v': {o}" + "}" for i, o in enumerate(["opa", "opb", "opc", "opd"])
)


def _turn(role: str, text: str) -> str:
    before, after = INSTRUCT_TEMPLATE[role]
    return f"{_q(before)} || {text} || {_q(after)}"


BEGIN, GENERATION = _q(INSTRUCT_TEMPLATE["begin"]), _q(INSTRUCT_TEMPLATE["generation"])
NUMBER_TARGET = "cop || '.'"
ANSWER_TARGET = f"{_q(ANSWER_PREFIX)} || ({CORRECT})"
SFT_TEXT = f"{BEGIN} || {_turn('user', '(' + MCQ_PROMPT + ')')} || {_turn('assistant', '(' + NUMBER_TARGET + ')')}"

# ---------------------------------------------------------------- tokens

TOKENS = f"toks as (select doc_id, {_words('lower(' + _fold('text') + ')')} as t from documents)"
_SPECIAL_LIST = "[" + ", ".join(_q(s) for s in SPECIAL_TOKENS) + "]"
VOCAB = (
    TOKENS + ", tok_rows as (select doc_id, unnest(t) as token, generate_subscripts(t, 1) as pos from toks), "
    f"top_tokens as (select token, count(*) as n from tok_rows where not list_contains({_SPECIAL_LIST}, token) "
    f"group by token order by n desc, token limit {VOCAB_SIZE}), "
    f"vocab as (select cast(row_number() over (order by n desc, token) + {len(SPECIAL_TOKENS) - 1} as int) as id, token, n "
    f"from top_tokens union all select cast(generate_subscripts({_SPECIAL_LIST}, 1) - 1 as int), "
    f"unnest({_SPECIAL_LIST}), 0)"
)
ENCODED = (
    VOCAB + ", encoded as (select doc_id, list(coalesce(v.id, 1) order by pos) as ids from tok_rows r "
    "left join vocab v on v.token = r.token group by doc_id)"
)
PIECES = (
    NER_ROWS + ", ner_pieces as (select sent_id, pos, tag, "
    f"list_transform(range(0, (len(token) - 1) // {WIDTH} + 1), lambda j: substr(lower(token), cast(j * {WIDTH} + 1 as int), {WIDTH})) as p "
    "from ner_rows), "
    "ner_split as (select sent_id, list_concat(['[CLS]'], list_concat(flatten(list(p order by pos)), ['[SEP]'])) as pieces, "
    "list_concat([cast(null as int)], list_concat(flatten(list(list_transform(p, lambda x: pos) order by pos)), [cast(null as int)])) as word_ids, "
    f"list_concat([{MASKED_LABEL}], list_concat(flatten(list(list_transform(p, lambda x, i: case when i = 1 then tag else {MASKED_LABEL} end) order by pos)), [{MASKED_LABEL}])) as labels, "
    f"list_concat([{MASKED_LABEL}], list_concat(flatten(list(list_transform(p, lambda x: tag) order by pos)), [{MASKED_LABEL}])) as all_labels "
    "from ner_pieces group by sent_id)"
)

# ---------------------------------------------------------------- vectors

VECTORS = "vecs as (select vec_id as item_id, cast(embedding as double[]) as v, label from embeddings)"
CENTROIDS = (
    VECTORS + ", cells as (select label, unnest(v) as x, generate_subscripts(v, 1) as i from vecs), "
    "means as (select label, i, avg(x) as x from cells group by label, i), "
    "centroids as (select label, list(x order by i) as c from means group by label)"
)
ANGULAR = "round(sqrt(greatest(0.0, 2.0 - 2.0 * list_cosine_similarity({a}, {b}))), 6) + 0.0::double"
OWN_DISTANCE = (
    CENTROIDS + f", own as (select vecs.label, item_id, {ANGULAR.format(a='v', b='c')} as distance "
    "from vecs join centroids on centroids.label = vecs.label)"
)
KNN = (
    CENTROIDS + ", knn as (select * from (select *, row_number() over (partition by query_id order by distance, item_id) "
    f"as rank from (select cast(centroids.label as bigint) as query_id, item_id, {ANGULAR.format(a='v', b='c')} as distance "
    "from centroids, vecs)) where rank <= 10)"
)
CLASSES = (
    "classes as (select cast(row_number() over (order by source) - 1 as int) as target, source as target_name "
    "from (select distinct source from documents))"
)

# ---------------------------------------------------------------- reports

REPORT = (
    PREDICTED + ", sides as (select cop as class, 1 as support, 0 as predicted, case when cop = prediction then 1 else 0 end as hits "
    "from predicted union all select prediction, 0, 1, 0 from predicted), "
    "per_class as (select class, sum(support) as support, sum(predicted) as predicted, sum(hits) as hits from sides group by class), "
    "rates as (select class, support, case when predicted = 0 then 0.0 else hits / predicted end as p, "
    "case when support = 0 then 0.0 else hits / support end as r, hits from per_class), "
    "scored as (select *, case when p + r = 0 then 0.0 else 2.0 * p * r / (p + r) end as f from rates) "
    f"select cast(class as varchar) as class, {_round('p')} as precision, {_round('r')} as recall, {_round('f')} as f1, cast(support as bigint) as support from scored "
    f"union all select 'accuracy', {_round('sum(hits) / sum(support)')}, {_round('sum(hits) / sum(support)')}, "
    f"{_round('sum(hits) / sum(support)')}, cast(sum(support) as bigint) from scored "
    f"union all select 'macro avg', {_round('avg(p)')}, {_round('avg(r)')}, {_round('avg(f)')}, cast(sum(support) as bigint) from scored "
    f"union all select 'weighted avg', {_round('sum(p * support) / sum(support)')}, {_round('sum(r * support) / sum(support)')}, "
    f"{_round('sum(f * support) / sum(support)')}, cast(sum(support) as bigint) from scored"
)
ENTITY = (
    RENUMBERED + ", " + _spans("kept", "label", "truth") + ", " + _spans("kept", "pred", "guess")
    + ", sides as (select type, 1 as t, 0 as g, 0 as m from truth union all select type, 0, 1, 0 from guess "
    "union all select truth.type, 0, 0, 1 from truth join guess on truth.sent = guess.sent and truth.type = guess.type "
    'and truth."start" = guess."start" and truth."end" = guess."end"), '
    "sums as (select coalesce(type, 'micro') as type, cast(sum(t) as bigint) as t, cast(sum(g) as bigint) as g, "
    "cast(sum(m) as bigint) as m from sides group by grouping sets ((type), ())) "
    "select type, t as true_spans, g as predicted_spans, m as matched_spans, "
    f"{_round('case when g = 0 then 0.0 else m / g end')} as precision, {_round('case when t = 0 then 0.0 else m / t end')} as recall, "
    f"{_round('case when t + g = 0 then 0.0 else 2.0 * m / (t + g) end')} as f1 from sums"
)
LOG = (
    "log as (select event_id, event_id // 5 as step, (event_id // 5) / 500.0::double as epoch, "
    "case when event_type = 'view' then value end as loss, case when event_type = 'purchase' then value end as eval_loss from events)"
)
SECONDS = "(date_diff('microsecond', min(ts), max(ts)) / 1000000.0::double)"
_FOLDED = [f"levenshtein({_fold('stripped')}, {_fold(o)})" for o in ("opa", "opb", "opc", "opd")]
MATCHED = (
    ANSWERED + f", stripped as (select *, case when starts_with(answer, {_q(ANSWER_PREFIX)}) then substr(answer, {len(ANSWER_PREFIX) + 1}) "
    f"else answer end as stripped from mcq_answered), dists as (select *, [{', '.join(_FOLDED)}] as d from stripped), "
    "found as (select *, case when list_min(d) is not null then cast(list_position(d, list_min(d)) - 1 as int) end as closest "
    "from dists), matched as (select *, coalesce(closest = cop, false) as is_correct from found)"
)
M1_TEXT = f"{BEGIN} || {_turn('user', '(' + MCQ_PROMPT + ')')} || {GENERATION}"

ORACLES: dict[str, str] = {
    "s1_read_split": _with(MCQ) + f"select id, question, cop, split from {_three_way('mcq', 'id')} where split = 'validation'",
    "s2_read_reviews_csv": _with(REVIEWS)
    + f"select id, case when clean_text not in ({', '.join(_q(t) for t in NULL_TOKENS)}) then clean_text end as clean_text, category from reviews",
    "s3_load_dataset": _with(MCQ) + f"select id, question, split from {_two_way('mcq', 'id', 0.3)} where split = 'test'",
    "s4_read_corpus": _with(CLASSES) + "select doc_id, text, target, target_name from documents join classes on source = target_name",
    "s5_write_results_csv": _with(PREDICTED)
    + "select id, nullif(question, '') as question, opa, opb, opc, opd, cop, choice_type, nullif(answer, '') as answer, prediction from predicted",
    "s7_write_metrics": _with(MCQ) + "select count(*) filter (split = 'train') as train_samples, "
    f"count(*) filter (split = 'test') as test_samples from {_two_way('mcq', 'id', 0.3)}",
    "p1_single_choice": _with(MCQ) + f"select id, cop, choice_type from mcq where {SINGLE}",
    "p2_drop_nulls": _with(REVIEWS) + "select * from reviews where category is not null and clean_text is not null",
    "p3_recode": _with(KNOWN) + "select id, category, category_1 from known",
    "p4_drop_columns": _with(NER_ROWS) + "select tag, count(*) as tokens, count(distinct token) as words from ner_rows group by tag",
    "p5_rename": _with(KNOWN) + "select id, clean_text as text, category_1 as label from known",
    "p5_instruction_output": _with(MCQ) + f"select id, {MCQ_PROMPT} as instruction, {NUMBER_TARGET} as output from mcq",
    "p6_label_dictionary": _with(NER_ROWS, f"names as (select generate_subscripts({NAMES}, 1) - 1 as label_id, unnest({NAMES}) as label)")
    + f"select cast(label_id as int) as label_id, label, {len(ENTITY_LABELS)} as num_labels, tokens from names left join "
    "(select tag, count(*) as tokens from ner_rows group by tag) on tag = label_id",
    "p7_format_columns": _with(ENCODED, KNOWN) + f"select known.id, {_joined('ids')} as input_ids, "
    f"{_joined('list_transform(ids, lambda x: 1)')} as attention_mask, category_1 as label from known join encoded on doc_id = known.id",
    "p8_preview": _with(MCQ, f"single as (select * from mcq where {SINGLE})")
    + f"select id, split, {SFT_TEXT} as text from {_two_way('single', 'id', 0.3)} order by {_hash('id')} limit 3",
    "f1_mcq_prompt": _with(MCQ) + f"select id, {MCQ_PROMPT} as prompt from mcq",
    "f2_exam_prompt": _with(MCQ) + f"select id, {EXAM_PROMPT} as prompt from mcq",
    "f2_exam_prompt_shuffled": _with(MCQ, f"shuffled as (select id, question, list_sort([{_KEYED}]) as o from mcq)")
    + f"select id, {_exam(['o[1].v', 'o[2].v', 'o[3].v', 'o[4].v'])} as prompt from shuffled",
    "f3_correct_option": _with(MCQ) + f"select id, cop, {CORRECT} as correct from mcq",
    "f4_target_text": _with(MCQ) + f"select id, {NUMBER_TARGET} as number_target, {ANSWER_TARGET} as answer_target from mcq",
    "f5_chat_messages": _with(MCQ) + f"select id, 0 as turn, 'user' as role, {EXAM_PROMPT} as content from mcq "
    f"union all select id, 1, 'assistant', {ANSWER_TARGET} from mcq",
    "f6_render_chat": "with turns as (select conv_id, turn, case role "
    + " ".join(f"when '{r}' then {_turn(r, 'text')}" for r in ("system", "user", "assistant"))
    + f" end as t from conversations), chats as (select conv_id, {BEGIN} || string_agg(t, '' order by turn) as text from turns group by conv_id) "
    f"select conv_id, text, text || {GENERATION} as prompt from chats",
    "f7_preprocess_text": f"select doc_id, array_to_string(list_filter({_words('lower(' + _fold('text') + ')')}, "
    f"lambda w: w not in ({', '.join(_q(s) for s in STOPWORDS)})), ' ') as clean from documents",
    "f8_parse_choice": _with(ANSWERED) + f"select id, answer, {PARSE} as prediction from mcq_answered",
    "f9_strip_prefix": _with(MATCHED) + "select id, stripped from stripped",
    "f10_closest_option": _with(MATCHED) + "select id, closest, is_correct from matched",
    "f11_argmax": "select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as pred, label from embeddings",
    "f12_ids_to_labels": _with(NER_ROWS) + f"select sent_id, string_agg({NAMES}[tag + 1], ' ' order by pos) as names, "
    "string_agg(cast(tag as varchar), ' ' order by pos) as ids from ner_rows group by sent_id",
    "f13_mask_filter": _with(NER_ROWS) + "select sent_id, "
    f"coalesce(string_agg(cast(pred as varchar), ' ' order by pos) filter (label <> {MASKED_LABEL}), '') as pred, "
    f"coalesce(string_agg(cast(label as varchar), ' ' order by pos) filter (label <> {MASKED_LABEL}), '') as label from ner_rows group by sent_id",
    "j1_merge_logs": _with(LOG) + "select t.epoch, t.step, t.loss, v.eval_loss, t.event_id as event_id_train, v.event_id as event_id_valid from (select * from log where loss is not null) t "
    "join (select * from log where loss is null and eval_loss is not null) v on t.epoch = v.epoch and t.step = v.step",
    "j2_lookup_neighbours": _with(KNN, CLASSES) + "select query_id, item_id, distance, cast(rank as int) as rank, text, target, target_name "
    "from knn left join documents on doc_id = item_id left join classes on source = target_name",
    "j3_write_back": _with(ANSWERED) + f"select m.id, m.question, m.cop, a.answer from mcq m left join "
    f"(select id, answer from mcq_answered where {SINGLE}) a on a.id = m.id",
    "j4_pair_predictions": _with(NER_ROWS) + "select label, pred, count(*) as n from ner_rows group by label, pred",
    "j5_knn_exact": _with(KNN) + "select query_id, item_id, distance, cast(rank as int) as rank from knn",
    "j7_encode_tokens": _with(ENCODED) + f"select doc_id, {_joined('ids')} as input_ids from encoded",
    "a1_class_counts": _with(KNOWN) + "select category_1, count(*) as count from known group by category_1",
    "a2_choice_scores": _with(PREDICTED) + f"select {_round('avg(case when cop = prediction then 1.0::double else 0.0::double end)')} as accuracy, "
    f"{_round('avg(case when cop = prediction then 0.0::double else 1.0::double end)')} as error_rate, "
    f"{_round('avg(case when prediction = -1 then 1.0::double else 0.0::double end)')} as invalid_rate from predicted",
    "a3_match_scores": _with(MATCHED) + "select count(*) filter (is_correct) as correct, count(*) as total, "
    "round(100.0::double * count(*) filter (is_correct) / count(*), 2) as percent from matched",
    "a4_classification_report": _with(REPORT.split(" select cast(class as varchar)")[0])
    + "select cast(class as varchar)" + REPORT.split(" select cast(class as varchar)")[1],
    "a5_confusion_matrix": _with(PREDICTED) + "select cop as label, "
    + ", ".join(f"count(*) filter (prediction = {c}) as pred_{str(c).replace('-', 'minus_')}" for c in (-1, 0, 1, 2, 3))
    + ", count(*) filter (coalesce(prediction not in (-1, 0, 1, 2, 3), true)) as pred_other from predicted group by cop",
    "a6_token_accuracy": _with(NER_ROWS) + "select count(*) as tokens, count(*) filter (pred = label) as hits, "
    f"{_round('count(*) filter (pred = label) / count(*)')} as accuracy from ner_rows where label <> {MASKED_LABEL}",
    "a7_entity_scores": "with " + ENTITY,
    "a8_assemble_sequence": _with(NER_ROWS) + "select sent_id, cast(count(*) as int) as n, string_agg(token, ' ' order by pos) as tokens from ner_rows group by sent_id",
    "a9_throughput": f"select event_type, count(*) as samples, {_round(SECONDS)} as seconds, {_round('count(*) / ' + SECONDS)} as per_second, "
    f"{_round('count(*) / ' + SECONDS + ' / 2.0')} as per_second_per_worker from events group by event_type",
    "a10_best_epoch": _with(LOG) + "select epoch, step, eval_loss from log where eval_loss is not null order by eval_loss, step limit 1",
    "a11_split_sizes": _with(MCQ) + f"select split, count(*) as count from {_two_way('mcq', 'id', 0.3)} group by split",
    "w1_bio_spans": _with(RENUMBERED, _spans("kept", "label", "truth")) + 'select sent, "start", "end", type from truth',
    "w1_bio_spans_rows": _with(NER_ROWS, f"unmasked as (select * from ner_rows where label <> {MASKED_LABEL})", _spans("unmasked", "label", "truth"))
    + 'select sent, "start", "end", type from truth',
    "w2_align_labels": _with(PIECES) + f"select sent_id, {_joined('labels')} as labels, {_joined('all_labels')} as all_labels from ner_split",
    "s6_save_load_index": "select tree, count(distinct embedding) as items, true as bounded from embeddings, (select cast(unnest(range(10)) as int) as tree) group by tree",
    "v4_every_item_in_every_tree": "select min(vec_id) as item_id, cast(10 as bigint) as trees, cast(10 as bigint) as postings from embeddings group by embedding",
    "v5_search_quality": "select vec_id as query_id, (select least(10, count(*)) from embeddings) as found, true as own, true as enough from embeddings",
    "j6_candidates_hold_the_query": "select vec_id as query_id, cast(1 as bigint) as own from embeddings",
    "w3_batch_index": "select doc_id, (row_number() over (order by doc_id) - 1) // 64 as batch from documents",
    "w3_batch_index_seeded": f"select doc_id, (row_number() over (order by {_hash('doc_id')}) - 1) // 8 as batch from documents",
    "w4_prefix_offsets": _with(TOKENS) + "select doc_id, cast(len(t) as int) as n, cast(coalesce(sum(len(t)) over "
    '(order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from toks',
    "w3_batch_index_text_key": "select concat_ws('-', source, lang, doc_id) as key, (row_number() over (order by concat_ws('-', source, lang, doc_id)) - 1) // 64 as batch from documents",
    "w4_prefix_offsets_text_key": _with(TOKENS) + "select concat_ws('-', source, lang, doc_id) as key, cast(len(t) as int) as n, cast(coalesce(sum(len(t)) over "
    "(order by concat_ws('-', source, lang, doc_id) rows between unbounded preceding and 1 preceding), 0) as bigint) as offset from toks join documents using (doc_id)",
    "w5_item_ids": "select vec_id, row_number() over (order by vec_id) - 1 as item from embeddings",
    "t1_sample_n": _with(MCQ) + f"select id, question, cop from mcq where {SINGLE} order by {_hash('id')} limit 500",
    "t2_split_exact": _with(KNOWN) + f"select id, clean_text as text, category_1 as label, split from {_three_way('known', 'id')}",
    "t3_train_test_split": _with(MCQ) + f"select id, split from {_two_way('mcq', 'id', 0.3)}",
    "t4_top_k_per_query": _with(OWN_DISTANCE) + "select label, item_id, distance, cast(rank as int) as rank from (select *, "
    "row_number() over (partition by label order by distance, item_id) as rank from own) where rank <= 10",
    "t5_order_by_count": "select source, count(*) as count from documents group by source",
    "k1_build_vocab": _with(VOCAB) + "select id, token, n from vocab",
    "k2_tokenize": _with(ENCODED) + f"select doc_id, {_joined(f'ids[1:{MAX_LEN}]')} as input_ids, "
    f"{_joined(f'list_transform(ids[1:{MAX_LEN}], lambda x: 1)')} as attention_mask from encoded",
    "k3_tokenize_presplit": _with(PIECES) + f"select sent_id, {_joined('pieces')} as pieces, {_joined('word_ids')} as word_ids, "
    f"{_joined('labels')} as labels from ner_split",
    "k4_pad_batch": _with(ENCODED, "cut as (select doc_id, ids, (row_number() over (order by doc_id) - 1) // 64 as batch from encoded)",
                          "longest as (select *, max(len(ids)) over (partition by batch) - len(ids) as missing from cut)")
    + f"select doc_id, batch, {_joined('list_concat(ids, list_transform(range(0, missing), lambda x: 0))')} as input_ids, "
    f"{_joined('list_concat(list_transform(ids, lambda x: 1), list_transform(range(0, missing), lambda x: 0))')} as attention_mask from longest",
    "k5_pack_sequences": _with(ENCODED, "stream as (select doc_id, unnest(list_append(ids, 3)) as id, generate_subscripts(list_append(ids, 3), 1) as pos from encoded)",
                               f"placed as (select id, row_number() over (order by doc_id, pos) - 1 as p from stream)")
    + f"select p // {BLOCK} as block, string_agg(cast(id as varchar), ' ' order by p) as input_ids from placed group by block having count(*) = {BLOCK}",
    "k6_truncate_sequences": _with(ENCODED) + f"select doc_id, cast(len(ids[1:1024]) as int) as n, {_joined('ids[1:1024]')} as input_ids from encoded",
    "k7_sft_dataset": _with(MCQ, f"chosen as (select * from mcq where {SINGLE} order by {_hash('id')})")
    + f"select id, split, {SFT_TEXT} as text from {_two_way('chosen', 'id', 0.3)}",
    "k7_exam_sft_dataset": _with(MCQ) + f"select id, {BEGIN} || {_turn('user', '(' + EXAM_PROMPT + ')')} || "
    f"{_turn('assistant', '(' + ANSWER_TARGET + ')')} as text from mcq",
    "v2_normalize_vectors": _with(VECTORS) + f"select item_id, cast(i as int) as pos, {_round('x / sqrt(s)')} as x from (select item_id, unnest(v) as x, "
    "generate_subscripts(v, 1) - 1 as i, list_sum(list_transform(v, lambda x: x * x)) as s from vecs)",
    "v3_angular_distance": _with(OWN_DISTANCE) + "select label, item_id, distance from own",
    "m1_score_batches": _with(MCQ, f"answered as (select id, 'Option ' || (length({M1_TEXT}) % 5) || ' of 9' as answer from mcq where {SINGLE})")
    + f"select id, answer, {PARSE} as prediction from answered",
    "m1_score_with_errors": _with(MCQ) + f"select id, 'Option ' || (length({EXAM_PROMPT}) % 5) || ' of 9' as answer, cast(null as varchar) as error from mcq",
    "m1_scored_run": _with(MCQ) + f"select count(*) as samples, count({EXAM_PROMPT}) as answers, true as timed from mcq",
}
ORACLES["a2_custom_metric"] = ORACLES["a2_choice_scores"]
