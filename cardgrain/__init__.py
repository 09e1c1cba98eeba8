"""cardgrain: card-transaction features, exploration statistics and tree
models as Spark DataFrame jobs.

Typical use on your own tables (schemas in ``cardgrain.sources.schemas``)::

    from cardgrain import card_features, fit_gbt, score, stratified_split
    feats = card_features(train, hist_tx, new_tx, merchants, ref_date="2018-02-01")
    parts = stratified_split(feats, "target")
    model = fit_gbt(parts.filter("part = 'train'"))
    preds = score(model, parts.filter("part = 'holdout'"), keep=("card_id", "target"))
"""

from cardgrain.operators.explore import (  # noqa: F401
    cards_by_month_set, gather, label_sets, month_target, month_trend, one_hot, proportions,
    top_ids_by_mean,
)
from cardgrain.operators.features import card_features, join_card_blocks  # noqa: F401
from cardgrain.operators.models import fit_gbt, fit_rf, score  # noqa: F401
from cardgrain.operators.ranks import (  # noqa: F401
    average_ranks, dense_rank_codes, exact_quantiles, global_positions, group_positions,
)
from cardgrain.operators.split import stratified_folds, stratified_split  # noqa: F401
from cardgrain.operators.stats import (  # noqa: F401
    equal_bins, kernel_density, pretty_bins, rmse, six_number_summary, spearman_long,
)
from cardgrain.operators.summaries import (  # noqa: F401
    category_counts, distinct_counts, hist_summary, mean_gap, merge_merchants, new_summary,
    order_distance, pivot_counts, stats6, term_features,
)
from cardgrain.session import build_session, checkpoint_dir  # noqa: F401
from cardgrain.sources.files import first_n, read_bundle, read_csv, write_bundle  # noqa: F401
