"""One query per operator over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.contracts import QUESTIONS, REVIEWS
from quillset.functions import answers as ans
from quillset.functions import prompts as pr
from quillset.functions import vectors as vec
from quillset.functions.fixed_values import ENTITY_LABELS, MASKED_LABEL
from quillset.functions.text import basic_tokens, preprocess_text
from quillset.functions.tokens import align_labels
from quillset.operators import classifiers, custom_metrics, embedding, forest, joins, logs, metrics, nearest, projections, ranks, scoring, sequences, spans
from quillset.operators.rows import explode_rows
from quillset.plans import evaluation, fixtures, retrieval, training_sets
from quillset.session import broadcast_if_small, materialise, scratch_path
from quillset.sources import sinks, tables

SEED = 42
VOCAB_SIZE = 5000
MAX_LEN = 512
BLOCK = 2048
PIECE_WIDTH = 4
DIGITS = 6


def text_of(array: Column | str) -> Column:
    """Array as one string, nulls shown, so that results compare across engines."""
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(column.cast("array<string>"), " ", "null")


def rounded(value: Column, digits: int = DIGITS) -> Column:
    return F.round(value, digits) + F.lit(0.0)


# ---------------------------------------------------------------- sources and sinks


def s1_read_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = ranks.split_exact(fixtures.mcq(spark, sf_dir), "id", 0.2, 0.1, SEED)
    path = scratch_path(spark, "mcq")
    questions.write.partitionBy("split").parquet(path)
    return tables.read_split(spark, path, "validation").select("id", "question", "cop", "split")


def s2_read_reviews_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_results_csv(fixtures.reviews(spark, sf_dir), scratch_path(spark, "reviews"))
    return tables.read_reviews_csv(spark, path, cut_files=True)


def s3_load_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks.split_exact(fixtures.mcq(spark, sf_dir), "id", 0.3, seed=SEED).createOrReplaceTempView("mcq_dataset")
    return tables.load_dataset(spark, "mcq_dataset", "test").select("id", "question", "split")


def s4_read_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, classes = tables.read_corpus(spark, f"{sf_dir}/documents.parquet")
    return documents.join(broadcast_if_small(classes), "target", "left").select("doc_id", "text", "target", "target_name")


def s5_write_results_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _predicted(spark, sf_dir).select(*[f.name for f in QUESTIONS.fields], "answer", "prediction")
    path = sinks.write_results_csv(results, scratch_path(spark, "results"))
    schema = T.StructType(
        [*QUESTIONS.fields, T.StructField("answer", T.StringType()), T.StructField("prediction", T.IntegerType())]
    )
    return sinks.read_results_csv(spark, path, schema)


def s6_save_load_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tree of a stored index: its items, and whether its leaves are as small as they should be."""
    items = fixtures.vectors(spark, sf_dir).select("item_id", "vector")
    loaded = sinks.load_index(spark, sinks.save_index(items, scratch_path(spark, "index")))
    sizes = loaded["postings"].groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("tree").agg(F.sum("n").alias("items"), (F.max("n") <= loaded["manifest"]["leaf_size"]).alias("bounded"))


def s7_write_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = ranks.train_test_split(fixtures.mcq(spark, sf_dir), "id", 0.3, SEED)
    one_row = split.agg(
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "test").alias("test_samples"),
    )
    path = sinks.write_metrics(one_row, scratch_path(spark, "metrics"))
    return sinks.read_metrics(spark, path, one_row.schema)


def _stored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled reviews as a table with one folder per split, as training reads them many times."""
    return materialise(training_sets.review_dataset(fixtures.reviews(spark, sf_dir), SEED), "review_splits", ["split"])


def s8_save_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = _stored_reviews(spark, sf_dir)
    model = classifiers.text_classifier().fit(dataset.filter("split = 'train'"))
    loaded = sinks.load_model(sinks.save_model(model, scratch_path(spark, "model")))
    return classifiers.predict(loaded, dataset.filter("split = 'test'")).select("id", "label", "predicted")


# ---------------------------------------------------------------- projections


def p1_single_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.single_choice(fixtures.mcq(spark, sf_dir)).select("id", "cop", "choice_type")


def p2_drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.drop_nulls(fixtures.reviews(spark, sf_dir), ["category", "clean_text"])


def p3_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.recode(p2_drop_nulls(spark, sf_dir), "category", "category_1").select("id", "category", "category_1")


def p4_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.drop_columns(fixtures.ner_rows(spark, sf_dir), "pred", "label").groupBy("tag").agg(
        F.count(F.lit(1)).alias("tokens"), F.count_distinct("token").alias("words")
    )


def p5_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.to_text_label(
        projections.recode(p2_drop_nulls(spark, sf_dir), "category", "category_1"), "clean_text", "category_1", "id"
    )


def p5_instruction_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fixtures.mcq(spark, sf_dir).select("id", pr.mcq_prompt().alias("prompt"), pr.target_number().alias("target"))
    return projections.to_instruction_output(pairs, "prompt", "target", "id")


def p6_label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = explode_rows(fixtures.ner(spark, sf_dir), "tags", "label_id")
    counts = tags.groupBy("label_id").agg(F.count(F.lit(1)).alias("tokens"))
    return projections.label_dictionary(counts, ENTITY_LABELS).join(counts, "label_id", "left")


def p7_format_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = p5_rename(spark, sf_dir)
    coded = sequences.tokenize(reviews, "text", _vocab(spark, sf_dir), "id")
    model_inputs = projections.format_columns(coded, "id", "input_ids", "attention_mask", "label")
    return model_inputs.select(
        "id", text_of("input_ids").alias("input_ids"), text_of("attention_mask").alias("attention_mask"), "label"
    )


def p8_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.preview(training_sets.sft_dataset(fixtures.mcq(spark, sf_dir)), "id", 3, SEED)


# ---------------------------------------------------------------- scalar functions


def f1_mcq_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq(spark, sf_dir).select("id", pr.mcq_prompt().alias("prompt"))


def f2_exam_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq(spark, sf_dir).select("id", pr.exam_prompt().alias("prompt"))


def f2_exam_prompt_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq(spark, sf_dir).select("id", pr.exam_prompt(True, F.col("id"), SEED).alias("prompt"))


def f3_correct_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq(spark, sf_dir).select("id", "cop", pr.correct_option().alias("correct"))


def f4_target_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq(spark, sf_dir).select(
        "id", pr.target_number().alias("number_target"), pr.target_answer().alias("answer_target")
    )


def f5_chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = pr.chat_messages(pr.exam_prompt(), pr.target_answer())
    return (
        fixtures.mcq(spark, sf_dir)
        .select("id", F.posexplode(messages).alias("turn", "m"))
        .select("id", "turn", "m.role", "m.content")
    )


def f6_render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = fixtures.table(spark, sf_dir, "conversations")
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    chats = sequences.assemble_sequence(
        turns.select("conv_id", "turn", message.alias("message")), ["conv_id"], "turn", "message", "messages"
    )
    return chats.select(
        "conv_id",
        pr.render_chat(F.col("messages")).alias("text"),
        pr.render_chat(F.col("messages"), add_generation_prompt=True).alias("prompt"),
    )


def f7_preprocess_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", preprocess_text(F.col("text")).alias("clean"))


def f8_parse_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq_answered(spark, sf_dir).select("id", "answer", ans.parse_choice(F.col("answer")).alias("prediction"))


def f9_strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mcq_answered(spark, sf_dir).select("id", ans.strip_prefix(F.col("answer")).alias("stripped"))


def f10_closest_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.matched_answers(fixtures.mcq_answered(spark, sf_dir)).select("id", "closest", "is_correct")


def f11_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.logits(spark, sf_dir).select("vec_id", ans.argmax(F.col("logits")).alias("pred"), "label")


def f12_ids_to_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fixtures.ner(spark, sf_dir).select("sent_id", ans.ids_to_labels(F.col("tags"), ENTITY_LABELS).alias("names"))
    return named.select(
        "sent_id", text_of("names").alias("names"), text_of(ans.labels_to_ids(F.col("names"), ENTITY_LABELS)).alias("ids")
    )


def f13_mask_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fixtures.ner(spark, sf_dir).select("sent_id", ans.mask_filter(F.col("pred"), F.col("label")).alias("pairs"))
    return kept.select(
        "sent_id", text_of(F.col("pairs.pred")).alias("pred"), text_of(F.col("pairs.label")).alias("label")
    )


# ---------------------------------------------------------------- joins


def j1_merge_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.merge_logs(fixtures.train_log(spark, sf_dir))


def j2_lookup_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, classes = tables.read_corpus(spark, f"{sf_dir}/documents.parquet")
    return joins.lookup_neighbours(j5_knn_exact(spark, sf_dir), documents, classes)


def j3_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = projections.single_choice(fixtures.mcq_answered(spark, sf_dir)).select("id", "answer")
    questions = fixtures.mcq(spark, sf_dir).select("id", "question", "cop")
    return joins.write_back(questions, answered, "id")


def j4_pair_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.ner_rows(spark, sf_dir)
    paired = joins.pair_predictions(rows.select("sent_id", "pos", "pred"), rows.select("sent_id", "pos", "label"))
    return metrics.confusion_counts(paired, "label", "pred")


def _centroid_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    centroids = nearest.class_centroids(fixtures.vectors(spark, sf_dir), "label")
    return centroids.select(F.col("label").cast("bigint").alias("query_id"), "vector")


def j5_knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to each class mean."""
    items = fixtures.vectors(spark, sf_dir).select("item_id", "vector")
    return nearest.knn_exact(_centroid_queries(spark, sf_dir), items, 10)


def j6_knn_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fixtures.vectors(spark, sf_dir).select("item_id", "vector")
    queries = items.withColumnRenamed("item_id", "query_id")
    return forest.knn_candidates(forest.build_index(items), queries)


def j6_candidates_hold_the_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a query that is an item has itself, or its first copy, among its candidates, and at most every item once."""
    items = fixtures.vectors(spark, sf_dir).select("item_id", "vector")
    index = forest.build_index(items)
    queries = items.withColumnRenamed("item_id", "query_id")
    own = index["copies"].select(F.col("item_id").alias("query_id"), F.col("rep").alias("target"))
    return forest.candidates_with(index, queries, own)


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents")
    return sequences.build_vocab(documents.select(basic_tokens(F.col("text")).alias("tokens")), "tokens", VOCAB_SIZE)


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", basic_tokens(F.col("text")).alias("tokens"))
    return sequences.encode_tokens(documents, "tokens", _vocab(spark, sf_dir), "doc_id").select("doc_id", "input_ids")


def _stored_ids(spark: SparkSession, sf_dir: str, max_len: int | None = None) -> DataFrame:
    """The encoded documents as a written table, for operators that read them more than once."""
    coded = _encoded(spark, sf_dir)
    if max_len is not None:
        coded = sequences.truncate_sequences(coded, max_len, "input_ids")
    return materialise(coded.withColumn("n", F.size("input_ids")), "encoded")


def j7_encode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir).select("doc_id", text_of("input_ids").alias("input_ids"))


# ---------------------------------------------------------------- aggregations


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = projections.single_choice(fixtures.mcq_answered(spark, sf_dir))
    return answered.withColumn("prediction", ans.parse_choice(F.col("answer")))


def a1_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_counts(p3_recode(spark, sf_dir), "category_1")


def a2_choice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.choice_scores(_predicted(spark, sf_dir))
    return scores.select(*[rounded(F.col(c)).alias(c) for c in scores.columns])


def a2_custom_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = custom_metrics.custom_metric(_predicted(spark, sf_dir), custom_metrics.ChoiceTally())
    return scores.select(*[rounded(F.col(c)).alias(c) for c in scores.columns])


def a3_match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.evaluate_matches(fixtures.mcq_answered(spark, sf_dir))


def a4_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(_predicted(spark, sf_dir), "cop", "prediction")
    return report.select("class", *[rounded(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


def a5_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_predicted(spark, sf_dir), "cop", "prediction", [-1, 0, 1, 2, 3])


def a6_token_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    accuracy = metrics.token_accuracy(fixtures.ner(spark, sf_dir))
    return accuracy.select("tokens", "hits", rounded(F.col("accuracy")).alias("accuracy"))


def a7_entity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = spans.entity_scores(fixtures.ner(spark, sf_dir))
    counts = ["type", "true_spans", "predicted_spans", "matched_spans"]
    return scores.select(*counts, *[rounded(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


def a8_assemble_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.ner_rows(spark, sf_dir).select("sent_id", "pos", "token")
    whole = sequences.assemble_sequence(rows, ["sent_id"], "pos", "token", "tokens")
    return whole.select("sent_id", F.size("tokens").alias("n"), text_of("tokens").alias("tokens"))


def a9_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.throughput(fixtures.table(spark, sf_dir, "events"), "event_type", "ts", workers=2)
    numbers = ("seconds", "per_second", "per_second_per_worker")
    return report.select("event_type", "samples", *[rounded(F.col(c)).alias(c) for c in numbers])


def a10_best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.best_epoch(fixtures.train_log(spark, sf_dir))


def a11_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.split_sizes(ranks.train_test_split(fixtures.mcq(spark, sf_dir), "id", 0.3, SEED))


# ---------------------------------------------------------------- window-style operators


def w1_bio_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = fixtures.ner(spark, sf_dir)
    kept = ans.mask_filter(F.col("pred"), F.col("label"))
    named = tagged.select("sent_id", kept.alias("pairs")).select(
        "sent_id", ans.ids_to_labels(F.col("pairs.label"), ENTITY_LABELS).alias("names")
    )
    return spans.bio_spans(named, "sent_id", "names")


def w1_bio_spans_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ENTITY_LABELS])
    rows = fixtures.ner_rows(spark, sf_dir).filter(F.col("label") != MASKED_LABEL)
    named = rows.select("sent_id", "pos", F.get(names, F.col("label")).alias("name"))
    return spans.bio_spans_rows(named, "sent_id", "pos", "name")


def w2_align_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sequences.tokenize_presplit(fixtures.ner(spark, sf_dir), "tokens", "tags", PIECE_WIDTH)
    return split.select(
        "sent_id",
        text_of("labels").alias("labels"),
        text_of(align_labels(F.col("word_ids"), F.col("tags"), True)).alias("all_labels"),
    )


def w3_batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = fixtures.table(spark, sf_dir, "documents").select("doc_id")
    return ranks.batch_index(keys, "doc_id", 64)


def w3_batch_index_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = fixtures.table(spark, sf_dir, "documents").select("doc_id")
    return ranks.batch_index(keys, "doc_id", 8, seed=SEED)


def w3_batch_index_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.batch_index(_text_keys(spark, sf_dir).select("key"), "key", 64)


def _text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents")
    return documents.select(F.concat_ws("-", "source", "lang", "doc_id").alias("key"), F.size(basic_tokens(F.col("text"))).alias("n"))


def w4_prefix_offsets_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.prefix_offsets(_text_keys(spark, sf_dir), "key", "n")


def w4_prefix_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.size(basic_tokens(F.col("text"))).alias("n"))
    return ranks.prefix_offsets(lengths, "doc_id", "n")


def w5_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.item_ids(fixtures.table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")


# ---------------------------------------------------------------- sampling, splits, top-k


def t1_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = projections.single_choice(fixtures.mcq(spark, sf_dir))
    return ranks.sample_n(single, 500, "id", SEED, allow_fewer=True).select("id", "question", "cop")


def t2_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_sets.review_dataset(fixtures.reviews(spark, sf_dir), SEED)


def t3_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.train_test_split(fixtures.mcq(spark, sf_dir), "id", 0.3, SEED).select("id", "split")


def _own_class_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fixtures.vectors(spark, sf_dir)
    # one row per class; the classes are read off the same table
    centroids = nearest.class_centroids(items, "label").withColumnRenamed("vector", "centroid")
    distance = vec.angular_distance(vec.as_doubles(F.col("vector")), F.col("centroid"))
    return items.join(nearest.broadcast_if_small(centroids), "label").select(
        "label", "item_id", rounded(distance).alias("distance")
    )


def t4_top_k_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.top_k_per_query(_own_class_distance(spark, sf_dir), 10, ("label",))


def t5_order_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fixtures.table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("count"))
    return metrics.order_by_count(counts, "source")


# ---------------------------------------------------------------- token sequences


def k1_build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocab(spark, sf_dir)


def k2_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sequences.tokenize(documents, "text", _vocab(spark, sf_dir), "doc_id", MAX_LEN)
    return coded.select(
        "doc_id", text_of("input_ids").alias("input_ids"), text_of("attention_mask").alias("attention_mask")
    )


def k3_tokenize_presplit(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sequences.tokenize_presplit(fixtures.ner(spark, sf_dir), "tokens", "tags", PIECE_WIDTH)
    return split.select(
        "sent_id", text_of("pieces").alias("pieces"), text_of("word_ids").alias("word_ids"), text_of("labels").alias("labels")
    )


def k4_pad_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ranks.batch_index(_stored_ids(spark, sf_dir), "doc_id", 64)
    padded = sequences.pad_batch(coded, length="n")
    return padded.select(
        "doc_id", "batch", text_of("input_ids").alias("input_ids"), text_of("attention_mask").alias("attention_mask")
    )


def k5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = sequences.pack_sequences(_stored_ids(spark, sf_dir), "doc_id", block=BLOCK, length="n")
    return packed.select("block", text_of("input_ids").alias("input_ids"))


def k6_truncate_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sequences.truncate_sequences(_encoded(spark, sf_dir), 1024, "input_ids")
    return cut.select("doc_id", F.size("input_ids").alias("n"), text_of("input_ids").alias("input_ids"))


def k7_sft_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = training_sets.sft_dataset(fixtures.mcq(spark, sf_dir))
    path = training_sets.write_sft_dataset(dataset, scratch_path(spark, "sft"))
    return tables.read_split(spark, path).select("id", "split", "text")


def k7_exam_sft_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_sets.exam_sft_dataset(fixtures.mcq(spark, sf_dir))


# ---------------------------------------------------------------- vectors


def v1_embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = embedding.embed_text(documents, embedding.fit_tfidf_encoder(documents))
    return vectors.select("doc_id", "vector")


def v2_normalize_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = vec.unit_vector(vec.as_doubles(F.col("vector")))
    return (
        fixtures.vectors(spark, sf_dir)
        .select("item_id", F.posexplode(unit).alias("pos", "x"))
        .select("item_id", "pos", rounded(F.col("x")).alias("x"))
    )


def v3_angular_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _own_class_distance(spark, sf_dir)


def v4_build_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.build_index(fixtures.vectors(spark, sf_dir).select("item_id", "vector"))["postings"]


def v4_every_item_in_every_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many trees hold each distinct vector, by the first of its ids."""
    return v4_build_index(spark, sf_dir).groupBy("item_id").agg(F.count_distinct("tree").alias("trees"), F.count(F.lit(1)).alias("postings"))


def v5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fixtures.vectors(spark, sf_dir).select("item_id", "vector")
    return forest.search(forest.build_index(items), items.withColumnRenamed("item_id", "query_id"))


def v5_search_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query the rows found, its own distance, and over all queries whether nine of ten true neighbours are found."""
    items = fixtures.vectors(spark, sf_dir).select("item_id", "vector")
    queries = items.withColumnRenamed("item_id", "query_id")
    found = materialise(v5_search(spark, sf_dir), "found")
    exact = nearest.knn_exact(queries, items, 10).select("query_id", "item_id")
    recall = exact.join(found.withColumn("hit", F.lit(1.0)), ["query_id", "item_id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("recall"))
    rows = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("found"), (F.min("distance") < 0.001).alias("own"))
    return rows.crossJoin(F.broadcast(recall)).select("query_id", "found", "own", (F.col("recall") >= 0.9).alias("enough"))  # recall: one row


def v6_retrieve_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents nearest to each benchmark text."""
    documents, classes = tables.read_corpus(spark, f"{sf_dir}/documents.parquet")
    encoder = embedding.fit_tfidf_encoder(documents)
    questions = fixtures.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    index = retrieval.index_documents(documents, encoder)
    return retrieval.retrieve_documents(index, encoder, questions, documents, classes)


# ---------------------------------------------------------------- models


def make_length_scorer() -> Callable[[np.ndarray], np.ndarray]:
    """A scorer whose answers can be written in SQL: the number of the option follows from the text length."""

    def score(texts: np.ndarray) -> np.ndarray:
        return np.array([f"Option {len(t) % 5} of 9" for t in texts], dtype=object)

    return score


def m1_score_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = evaluation.answer_questions(fixtures.mcq(spark, sf_dir), make_length_scorer)
    return answered.select("id", "answer", "prediction")


def m1_score_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompted = fixtures.mcq(spark, sf_dir).select("id", pr.exam_prompt().alias("prompt"))
    return scoring.score_batches_with_errors(prompted, "prompt", make_length_scorer).select("id", "answer", "error")


def m1_scored_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompted = fixtures.mcq(spark, sf_dir).select("id", pr.exam_prompt().alias("prompt"))
    written, log = scoring.score_to_table(prompted, "prompt", make_length_scorer, scratch_path(spark, "scored"))
    stored = written.agg(F.count("answer").alias("answers"))  # one row, as the log
    return log.join(F.broadcast(stored)).select("samples", "answers", (F.col("per_second") > 0).alias("timed"))


def m2_train_text_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = _stored_reviews(spark, sf_dir)
    _, scores = classifiers.train_text_classifier(
        dataset.filter("split = 'train'"), dataset.filter("split = 'validation'")
    )
    return scores


def m3_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = _stored_reviews(spark, sf_dir)
    model = classifiers.text_classifier().fit(dataset.filter("split = 'train'"))
    predicted = classifiers.predict(model, dataset.filter("split = 'test'"))
    return metrics.classification_report(predicted, "label", "predicted")


def m4_train_token_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = materialise(ranks.train_test_split(fixtures.named_words(spark, sf_dir), "sent_id", 0.2, SEED), "sentences")
    train, test = sentences.filter("split = 'train'"), sentences.filter("split = 'test'")
    model = classifiers.train_token_classifier(train, "tokens", "tags")
    weights = classifiers.sequence_weights(model, train, "tags")
    return classifiers.evaluate_tags(classifiers.tag_sentences(model, weights, test, "sent_id", "tokens", "tags"), "tags")


def m5_tag_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = materialise(fixtures.named_words(spark, sf_dir), "sentences")
    model = classifiers.train_token_classifier(sentences, "tokens", "tags")
    weights = classifiers.sequence_weights(model, sentences, "tags")
    benchmark = fixtures.table(spark, sf_dir, "benchmark")
    return classifiers.tag_entities(model, benchmark, "item_id", "text", weights=weights)


def m6_hyperparameter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = _stored_reviews(spark, sf_dir)

    def to_param_map(pipeline, trial: dict) -> dict:
        hashing, regression = pipeline.getStages()[2], pipeline.getStages()[4]
        return {regression.regParam: trial["reg_param"], hashing.numFeatures: int(trial["features"])}

    return classifiers.hyperparameter_search(
        lambda: classifiers.text_classifier(),
        to_param_map,
        dataset.filter("split = 'train'"),
        dataset.filter("split = 'validation'"),
        {"reg_param": ("log", 1e-3, 1e-1), "features": ("choice", [1 << 10, 1 << 12, 1 << 14])},
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: function
    for name, function in list(globals().items())
    if callable(function) and name[0] in "spfjawtkvm" and name[1:2].isdigit()
}
