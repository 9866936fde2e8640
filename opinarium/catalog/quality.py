"""Model quality on prediction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.catalog import views as v
from opinarium.catalog.registry import Tables, query
from opinarium.catalog.storage import EPOCHS_SQL, epoch_metrics
from opinarium.functions import losses
from opinarium.functions.labels import one_hot, sigmoid, threshold
from opinarium.operators import evaluate


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {c for c, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else c for c in df.columns])


@query(
    f"""with {v.FAILING_SQL}
    select round(avg(case when pred = label then 1.0 else 0.0 end), 6) as accuracy
    from predictions"""
)
def eval_accuracy(t: Tables) -> DataFrame:
    return _rounded(evaluate.accuracy(v.failing_predictions(t)))


def _report_sql(label: str, pred: str) -> str:
    return f"""
classes as (
  select {label} as class from predictions
  union select {pred} from predictions where {pred} is not null),
counts as (
  select c.class,
         (select count(*) from predictions where {label} = c.class and {pred} = c.class) as tp,
         (select count(*) from predictions where {label} = c.class) as support,
         (select count(*) from predictions where {pred} = c.class) as predicted
  from classes c),
rates as (
  select *, case when predicted = 0 then 0.0 else tp / predicted end as precision_,
         case when support = 0 then 0.0 else tp / support end as recall_,
         case when support + predicted = 0 then 0.0 else 2.0 * tp / (support + predicted) end as f1_
  from counts),
{AVERAGES_SQL}"""


AVERAGES_SQL = """
averages as (
  select 'macro avg' as class, avg(precision_) as p, avg(recall_) as r, avg(f1_) as f,
         sum(support) as s from rates
  union all
  select 'weighted avg', sum(precision_ * support) / sum(support),
         sum(recall_ * support) / sum(support), sum(f1_ * support) / sum(support), sum(support)
  from rates
  union all
  select 'micro avg', sum(tp) / sum(predicted), sum(tp) / sum(support),
         2.0 * sum(tp) / (sum(support) + sum(predicted)), sum(support)
  from rates),
report as (
  select cast(class as varchar) as class, precision_ as p, recall_ as r, f1_ as f, support as s
  from rates
  union all select * from averages)"""

SHOW_REPORT_SQL = """select class, round(cast(p as double), 4) as precision,
  round(cast(r as double), 4) as recall, round(cast(f as double), 4) as f1,
  cast(s as bigint) as support from report"""


@query(f"with {v.FAILING_SQL}, {_report_sql('label', 'pred')} {SHOW_REPORT_SQL}")
def eval_class_report(t: Tables) -> DataFrame:
    return evaluate.class_report(v.failing_predictions(t))


@query(
    f"""with {v.FAILING_SQL}, {_report_sql('label', 'pred')},
    named as (select case class when '0' then 'zero' when '9' then 'nine' else class end as class,
                     p, r, f, s from report)
    {SHOW_REPORT_SQL.replace('from report', 'from named')}"""
)
def eval_class_names(t: Tables) -> DataFrame:
    """The report with names given by class id."""
    return evaluate.class_report(v.failing_predictions(t), names={0: "zero", 9: "nine"})


@query(
    f"""with {v.FAILING_SQL},
    classes as (
      select label as class from predictions
      union select pred from predictions where pred is not null)
    select a.class as label, b.class as pred, count(p.id) as n
    from classes a cross join classes b
    left join predictions p on p.label = a.class and p.pred = b.class
    group by a.class, b.class
    union all select label, null, count(*) from predictions where pred is null group by label"""
)
def eval_confusion(t: Tables) -> DataFrame:
    """With zero cells, and failed predictions in cells of their own."""
    return evaluate.confusion_matrix(v.failing_predictions(t))


@query(
    f"""with {v.FAILING_SQL}
    select label, {', '.join(f'count(*) filter (where emotion = {e}) as "{e}"' for e in range(3))}
    from predictions group by label"""
)
def eval_confusion_wide(t: Tables) -> DataFrame:
    return evaluate.confusion_wide(v.failing_predictions(t), [0, 1, 2], pred="emotion")


PROBS_SQL = f"""
probs as (
  select *, {v.sigmoid_sql('scores')} as q,
         list_transform({v.sigmoid_sql('scores')}, lambda x: case when x >= 0.5 then 1 else 0 end)
           as guess
  from predictions)"""


def _probs(t: Tables) -> DataFrame:
    rows = v.predictions(t).withColumn("q", sigmoid(F.col("scores")))
    return rows.withColumn("guess", threshold(F.col("q")))


@query(
    f"""with {v.PREDICTIONS_SQL}, {PROBS_SQL},
    equal as (
      select len(list_filter(list_zip(truth, guess), lambda z: z[1] = z[2])) as n, len(truth) as size
      from probs)
    select round(sum(n) / sum(size), 6) as cell_accuracy, round(avg(n / size), 6) as row_accuracy
    from equal"""
)
def eval_cell_accuracy(t: Tables) -> DataFrame:
    return _rounded(evaluate.cell_accuracy(_probs(t), "truth", "guess"))


@query(
    f"""with {v.PREDICTIONS_SQL}, {PROBS_SQL},
    cells as (
      select unnest(range(0, 10)) as class, unnest(truth) as y, unnest(guess) as p from probs),
    counts as (
      select class, sum(y * p) as tp, sum(y) as support, sum(p) as predicted from cells group by class),
    rates as (
      select *, case when predicted = 0 then 0.0 else tp / predicted end as precision_,
             case when support = 0 then 0.0 else tp / support end as recall_,
             case when support + predicted = 0 then 0.0 else 2.0 * tp / (support + predicted) end as f1_
      from counts),
    {AVERAGES_SQL},
    rows_ as (
      select list_sum(list_transform(list_zip(truth, guess), lambda z: z[1] * z[2])) as tp,
             list_sum(truth) as support, list_sum(guess) as predicted
      from probs),
    samples as (
      select 'samples avg' as class, avg(case when predicted = 0 then 0.0 else tp / predicted end) as p,
             avg(case when support = 0 then 0.0 else tp / support end) as r,
             avg(case when support + predicted = 0 then 0.0
                      else 2.0 * tp / (support + predicted) end) as f, sum(support) as s
      from rows_),
    both_ as (select * from report union all select * from samples)
    {SHOW_REPORT_SQL.replace('from report', 'from both_')}"""
)
def eval_multi_label_report(t: Tables) -> DataFrame:
    return evaluate.multi_label_report(_probs(t), "truth", "guess")


@query(
    f"""with {v.PREDICTIONS_SQL}
    select id, {v.argmax_sql('truth')} as label, {v.argmax_sql('scores')} as pred
    from predictions"""
)
def eval_first_maximum(t: Tables) -> DataFrame:
    rows = v.predictions(t).drop("label", "pred")
    return evaluate.first_maximum(rows, "truth", "scores").select("id", "label", "pred")


def _ce_sql(vector: str) -> str:
    return (
        f"(list_max({vector}) + ln(list_sum(list_transform({vector}, "
        f"lambda z: exp(z - list_max({vector}))))) - {vector}[label + 1])"
    )


@query(
    f"""with {v.PREDICTIONS_SQL},
    p as (select *, {v.softmax_sql('scores')} as probs from predictions)
    select round(avg({_ce_sql('scores')}), 6) as from_logits,
           round(avg(-ln(probs[label + 1])), 6) as from_probs,
           round(avg({_ce_sql('probs')}), 6) as normalised_twice
    from p"""
)
def eval_cross_entropy(t: Tables) -> DataFrame:
    from opinarium.functions.labels import softmax

    rows = v.predictions(t).withColumn("probs", softmax(F.col("scores")))
    label = F.col("label")
    kinds = {
        "from_logits": losses.cross_entropy(F.col("scores"), label),
        "from_probs": losses.cross_entropy(F.col("probs"), label, "probs"),
        "normalised_twice": losses.cross_entropy(F.col("scores"), label, "probs_as_logits"),
    }
    return rows.agg(*[F.round(F.avg(loss), 6).alias(name) for name, loss in kinds.items()])


def _bce_sql(probs: str, truth: str) -> str:
    return (
        f"(list_sum(list_transform(list_zip({probs}, {truth}), lambda z: "
        f"-(z[2] * greatest(ln(z[1]), -100) + (1 - z[2]) * greatest(ln(1 - z[1]), -100)))) "
        f"/ len({truth}))"
    )


@query(
    f"""with {v.PREDICTIONS_SQL}, {PROBS_SQL}
    select round(avg({_bce_sql('q', 'truth')}), 6) as loss from probs"""
)
def eval_binary_cross_entropy(t: Tables) -> DataFrame:
    loss = losses.binary_cross_entropy(F.col("q"), F.col("truth"))
    return _rounded(evaluate.mean_loss(_probs(t), loss))


TWO_TARGETS_SQL = f"""
two as (
  select *, list_transform(range(0, 10), lambda i: case when i = label then 1 else 0 end) as hot
  from probs),
each as (select {_bce_sql('q', 'truth')} as a, {_bce_sql('q', 'hot')} as b from two)"""


@query(
    f"""with {v.PREDICTIONS_SQL}, {PROBS_SQL}, {TWO_TARGETS_SQL}
    select round(avg(a), 6) as loss1, round(avg(b), 6) as loss2,
           round((avg(a) + avg(b)) / 2, 6) as loss
    from each"""
)
def eval_two_target_loss(t: Tables) -> DataFrame:
    rows = _probs(t).withColumn("hot", one_hot(F.col("label"), 10))
    first = losses.binary_cross_entropy(F.col("q"), F.col("truth"))
    second = losses.binary_cross_entropy(F.col("q"), F.col("hot"))
    return _rounded(evaluate.two_target_loss(rows, first, second))


@query(
    f"""with {v.PREDICTIONS_SQL},
    cooled as (
      select *, list_transform(scores, lambda x: x / 2.0) as s2,
             list_transform(teacher, lambda x: x / 2.0) as t2 from predictions),
    soft as (
      select *, {v.softmax_sql('t2')} as pt, {v.softmax_sql('s2')} as ps from cooled),
    rows_ as (
      select 0.3 * 4 * list_sum(list_transform(list_zip(pt, ps), lambda z:
               z[1] * (ln(z[1]) - ln(z[2])))) / len(pt) + 0.7 * {_ce_sql('scores')} as loss
      from soft)
    select round(avg(loss), 6) as loss from rows_"""
)
def eval_distillation_loss(t: Tables) -> DataFrame:
    loss = losses.distillation_loss(F.col("scores"), F.col("teacher"), F.col("label"), 0.3, 2.0)
    return _rounded(evaluate.mean_loss(v.predictions(t), loss))


@query(
    f"""with {v.PREDICTIONS_SQL},
    numbered as (
      select *, (row_number() over (order by id) - 1) // 32 as batch from predictions),
    batches as (
      select batch, avg({_ce_sql('scores')}) as loss,
             avg(case when pred = label then 1.0 else 0.0 end) as accuracy
      from numbered group by batch)
    select count(*) as batches, round(avg(loss), 6) as loss, round(avg(accuracy), 6) as accuracy
    from batches"""
)
def eval_batch_means(t: Tables) -> DataFrame:
    metrics = {
        "loss": losses.cross_entropy(F.col("scores"), F.col("label")),
        "accuracy": (F.col("pred") == F.col("label")).cast("int"),
    }
    return _rounded(evaluate.batch_means(v.predictions(t), ["id"], 32, metrics))


@query(
    f"""with {EPOCHS_SQL}
    select 'embeddings' as run, epoch, 'accuracy' as metric, accuracy as value from metrics
    union all select 'embeddings', epoch, 'top_score', top_score from metrics"""
)
def eval_epoch_history(t: Tables) -> DataFrame:
    return evaluate.history_rows(
        epoch_metrics(t), F.lit("embeddings"), F.col("epoch"), ["accuracy", "top_score"]
    )


@query(
    f"""with {EPOCHS_SQL}
    (select 'best' as kind, * from metrics order by accuracy desc, epoch desc limit 1)
    union all (select 'last', * from metrics order by epoch desc limit 1)"""
)
def eval_best_and_last(t: Tables) -> DataFrame:
    from opinarium.sinks.files import best_and_last

    return best_and_last(epoch_metrics(t))
