"""contentlake: a content repository held as Spark tables.

Documents, their folder tree, binaries, access lists, audit history and
workflows are DataFrames; every repository task (lookup, listing, paged
query, property flattening, create / update / trash / delete, upload,
workflow start / cancel, named operations) is a set-at-a-time DataFrame
operator that routes each row to a ``success``, ``failure``, ``original``
or ``next_page`` output.
"""

from contentlake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
