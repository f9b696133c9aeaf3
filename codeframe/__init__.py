"""Labelled survey and census data on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .codebook import (  # noqa: E402
    Codebook, CodebookTables, Variable, first_by_name, label_table, val_labels, var_desc, var_info, var_label,
)
from .metadata import (
    ALL_ATTRS, Lbl, VarMeta, all_meta, get_meta, is_factor, is_labelled, labelled_columns, lbl, with_meta,
)
from .operators.bind import bind_layers, bind_rows
from .operators.joins import (
    JoinResult, area_with_boundaries, coded_area_with_boundaries, full_join, inner_join, left_join, rectangularize,
    right_join, shape_join,
)
from .operators.labels import (
    as_factor, decode_with_table, duplicate_labels, label_table_for_values, lbl_add, lbl_add_vals, lbl_clean,
    lbl_collapse, lbl_define, lbl_na_if, lbl_relabel, longest_labels, set_attributes, unlabelled_values,
    zap_attributes, zap_labels,
)
from .operators.models import Factor, LinearFit, generalized_model, linear_model
from .operators.recode import case_when, cut, harmonise, null_if, select_cases
from .operators.tabulate import (
    area_summary, distinct_count, first_per_group, household_frequency, rows_at_extremes, share_of, top_k,
    two_way_table, value_counts, weighted_frequency, weighted_mean, weighted_mean_expr, with_share,
)
from .plans.extract import (
    Extract, collections, define_extract, extract_from_json, extract_info, extract_log, is_ready, last_extract,
    recent_extracts, revise_extract, run_extract, save_extract, subsample, write_extract,
)
from .select import (
    contains, ends_with, everything, exclude, matches, mutate_at, num_range, one_of, pick, select_rows, starts_with,
)
from .session import build_session, sized_settings, tune
from .sources.area import read_area_table, read_area_utf8, read_mixed_micro
from .sources.boundary import read_boundaries
from .sources.carried import read_micro_rectangular
from .sources.ddi import read_codebook, read_codebook_tables
from .sources.files import find_files, list_data, list_files, list_raster, list_shape
from .sources.micro import collect_with_labels, read_micro, read_micro_list
from .sources.sinks import write_csv, write_fixed_width, write_hierarchical, write_parquet
from .sources.textbook import read_text_codebook
from .streaming.chunks import (
    ListRowReader, RowReader, batch_map, chunk_list, chunk_map, chunk_reduce, chunk_side_effect, read_micro_chunked,
    read_micro_list_chunked, read_micro_list_pulled, read_micro_pulled, with_chunk_id, with_row_no,
)
from .streaming.lines import LineIndex, LineReader, build_line_index, open_line_index
from .streaming.running import load_rows, load_stream, running_tabulation, stream_micro, stream_table
