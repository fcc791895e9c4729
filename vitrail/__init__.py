"""vitrail: tabular machine-learning analytics on Spark DataFrames.

Ingest delimited / libsvm / edge-list text with accounting of malformed rows, profile
tables, split reproducibly, train and score Spark ML classifiers and clusterings, and
evaluate them -- every operator takes and returns DataFrames.

Modules::

    vitrail.session              local_session, checkpoint / scratch folders, partition sizing
    vitrail.sources.delimited    read_lines, load_table, load_profile, parse_lines, coerce,
                                 fault_examples
    vitrail.sources.points       load_labeled_points, parse_labeled_points, parse_edges,
                                 read_libsvm, write_libsvm, tag_libsvm, parse_libsvm
    vitrail.functions.text       strip_accents, strip_quotes
    vitrail.operators.describe   class_distribution, column_stats, correlation_matrix,
                                 pairwise_correlation, describe_numeric
    vitrail.operators.quantiles  exact_quantiles, approx_quantiles
    vitrail.operators.split      hash_split, random_split, sample_rows (+ *_tag variants)
    vitrail.operators.numbering  number_rows, running_sums, pair_rows, file_order
    vitrail.operators.metrics    confusion_matrix, one_vs_rest, per_class_metrics,
                                 macro_summary, summarize, accuracy, multilabel_metrics
    vitrail.operators.models     fit_classifier, Classifier, estimator presets,
                                 index_labels, index_features, unseen_categories,
                                 fitted parameters
    vitrail.operators.cluster    kmeans_best_of, centres_by_label, assign_nearest,
                                 distance_sums, cluster_label_counts, crosstab,
                                 gaussian_mixture, mixture_moments
    vitrail.operators.graph      normalise_edges, power_iteration_clusters
    vitrail.streaming.ingest     the delimited parser on file streams
"""

__version__ = "0.1.0"
