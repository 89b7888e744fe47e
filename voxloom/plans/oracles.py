"""DuckDB SQL for the queries of the registry."""

from __future__ import annotations

from voxloom.fixtures import INTERVALS

_VAD = f"vad as (select rec recording_id, seq, s, e from ({INTERVALS}))"

_MERGED = _VAD + """,
g as (select *, case when s - lag(e) over (partition by recording_id order by seq) < 0.5::double then 0 else 1 end b from vad),
i as (select *, sum(b) over (partition by recording_id order by seq) isl from g),
merged as (select recording_id, min(seq) seq, arg_min(s, seq) s, arg_max(e, seq) e from i group by recording_id, isl)"""

_MERGE_SEGMENTS = _MERGED + """,
c as (select *, e - s dur, case when e - s <= 30 then 1::double else greatest(1::double, round_even((e - s) / 25::double, 0)) end n from merged),
x as (select *, unnest(range(0, n::bigint)) part from c),
y as (select recording_id, seq, part, case when dur <= 30 then s else s + part * (dur / n) end s,
             case when dur <= 30 then e else s + (part + 1) * (dur / n) end e from x),
segments as (select recording_id, row_number() over (partition by recording_id order by seq, part) - 1 idx, s, e from y where e - s >= 1::double)"""

_PACKED = _VAD + """,
walk as (
  select recording_id, seq, s, e, s start, 0::bigint pack from vad where seq = 0
  union all
  select v.recording_id, v.seq, v.s, v.e, case when v.e - w.start <= 20 then w.start else v.s end,
         case when v.e - w.start <= 20 then w.pack else w.pack + 1 end
  from walk w join vad v on v.recording_id = w.recording_id and v.seq = w.seq + 1),
packed as (select recording_id, pack seq, min(start) s, arg_max(e, seq) e from walk group by recording_id, pack)"""

_PACK_SPLIT = _PACKED + """,
c as (select *, e - s dur, case when e - s <= 30 then 1::double else greatest(1::double, round_even((e - s) / 15::double, 0)) end n from packed),
x as (select *, unnest(range(0, n::bigint)) part from c),
cut as (select recording_id, row_number() over (partition by recording_id order by seq, part) - 1 idx,
             case when dur <= 30 then s else s + part * (dur / n) end s,
             case when dur <= 30 then e else s + (part + 1) * (dur / n) end e from x)"""

_PACK_SEGMENTS = _PACK_SPLIT + """,
f as (select *, sum(case when e - s >= 5 then 1 else 0 end) over (partition by recording_id order by idx) grp from cut),
a as (select *, first_value(s) over (partition by recording_id, grp order by idx) anchor from f where grp > 0),
k as (select recording_id, grp, min(anchor) s, arg_max(e, idx) e from a where e - s >= 5 or e - anchor <= 30 group by recording_id, grp),
segments as (select recording_id, row_number() over (partition by recording_id order by grp) - 1 idx, s, e from k where e - s >= 5)"""


def _offsets(segments: str, digits: int, least: int) -> str:
    return f"""{segments},
len as (select recording_id, trunc((max(e) - 0.25::double) * 24000::double)::bigint n_samples from vad group by recording_id),
o as (select recording_id, idx, trunc(s * 24000::double)::bigint start_sample, least(trunc(e * 24000::double)::bigint, n_samples) end_sample
      from segments join len using (recording_id)),
offsets as (select printf('%s_%0{digits}d', recording_id::varchar, idx) segment_id, recording_id, idx, start_sample, end_sample,
            greatest(0, end_sample - start_sample)::double / 24000::double dur_s from o
            where greatest(0, end_sample - start_sample)::double / 24000::double >= {least})"""


_SAMPLES = """
n0 as (select vec_id, label, (vec_id % 65)::int n, embedding from embeddings),
n1 as (select *, list_transform(embedding[1:n], lambda x: trunc(abs(x::double) * 50 * (label + 1))::bigint) inc from n0),
n2 as (select *, list_transform(range(1, n + 1), lambda i: list_sum(inc[1:i])::bigint) positions from n1),
f2 as (select printf('r%03d_%04d', vec_id // 8, vec_id % 8) segment_id, printf('r%03d', vec_id // 8) recording_id,
       range(1, n + 1) token_ids, positions, coalesce(positions[len(positions)], 0) + 25 duration_frames, vec_id, n from n2)"""


def _judged(least: str) -> str:
    return f"""{_SAMPLES},
d as (select *, list_transform(range(1, n), lambda i: positions[i + 1] - positions[i]) steps from f2),
judged as (select *, case when n = 0 then 'empty_tokens'
    when duration_frames / 50::double < {least} then 'too_short'
    when duration_frames / 50::double > 30 then 'too_long'
    when len(list_filter(range(1, n - 2), lambda i: positions[i] = positions[i + 1] and positions[i] = positions[i + 2] and positions[i] = positions[i + 3])) > 0
      then 'consecutive_frames'
    when list_max(steps) > 150 then 'large_gap' end reason from d),
manifest as (select segment_id, 'speech' dataset, n::bigint num_tokens, duration_frames, 'features/' || segment_id || '.pt' feature_path, vec_id
             from judged where reason is null),
recs as (select distinct regexp_replace(segment_id, '_[^_]*$', '') recording_id from manifest),
ranked as (select recording_id, row_number() over (order by md5('42:' || recording_id), recording_id) - 1 pos, count(*) over () total from recs),
split as (select recording_id, pos, case when pos < floor(total * 0.95::double) then 'train' else 'val' end split from ranked),
assigned as (select m.*, s.recording_id, pos, split from manifest m join split s on s.recording_id = regexp_replace(m.segment_id, '_[^_]*$', ''))"""


_J = _judged("1::double")
_TEXT = "array_to_string({}, ',')"

_REMOTE = """remote as (select 'audio/' || lang || '/' || doc_id || '_' || source || '.mp3' key, n_chars size,
  doc_id || '_' || source || '.mp3' name, doc_id::varchar recording_id from documents),
local as (select doc_id || '_' || source || '.mp3' name, n_chars + case when doc_id % 7 = 0 then 1 else 0 end size from documents where doc_id % 3 <> 0),
plan as (select key, size, name, recording_id from remote r where not exists (select 1 from local l where l.name = r.name and l.size = r.size))"""

_UPLOAD = _J + """,
up as (
  select unnest(['manifest.json', 'manifest_train.json', 'manifest_val.json']) local_, n local_size from (select count(*) n from manifest)),
candidates as (
  select local_ as local, 'processed/' || local_ as key, local_size from up
  union all
  select feature_path, 'processed/features/' || segment_id || '.pt', duration_frames from manifest where vec_id % 6 <> 0),
idx as (select 'processed/features/' || segment_id || '.pt' key, duration_frames + case when vec_id % 9 = 0 then 1 else 0 end size
        from manifest where vec_id % 4 <> 0)"""

_CHECKS = _J + """,
feat as (select segment_id, n, vec_id from f2 where vec_id % 17 <> 0),
checks as (
  select split, a.segment_id, f.segment_id is not null as found,
         case when f.segment_id is null then 'token_ids,encoder_features,positions,f_before,f_after'
              when f.vec_id % 13 = 0 then 'encoder_features' else '' end missing,
         f.segment_id is not null and f.vec_id % 13 <> 0 and (f.n = 0 or f.vec_id % 11 <> 0) shaped
  from assigned a left join feat f on f.segment_id = a.segment_id),
checked as (select *, found and missing = '' and shaped passed from checks),
results as (
  select split || '_keys' as "check", bool_and(passed) passed from checked group by split
  union all
  select 'disjoint', count(*) = 0 from (
    select recording_id from assigned where split = 'train' intersect select recording_id from assigned where split = 'val'))"""

_BATCHED = _SAMPLES + """,
nb as (select *, (row_number() over (partition by recording_id order by segment_id) - 1) // {size} batch from f2),
lb as (select *, max(n) over (partition by recording_id, batch) longest from nb)"""


def oracle_sql() -> dict[str, str]:
    return {
        "segment_merge": f"with {_MERGED} select recording_id, seq, s, e from merged",
        "segment_split": f"with {_MERGE_SEGMENTS} select * from segments",
        "segment_pack_greedy": f"with recursive {_PACKED} select recording_id, seq, s, e from packed",
        "segment_pack_split": f"with recursive {_PACK_SPLIT} select recording_id, idx, s, e from cut",
        "segment_pack_final": f"with recursive {_PACK_SEGMENTS} select * from segments",
        "segment_stats": f"""with recursive {_PACK_SEGMENTS},
m as (select recording_id, round((e - s) * 1000)::bigint ms from segments)
select recording_id, count(*) n_segments, (sum(ms)::double / count(*)) / 1000::double mean_s, min(ms) / 1000::double min_s,
       max(ms) / 1000::double max_s, sum(ms)::double / 1000::double total_s from m group by recording_id""",
        "segment_slice_offsets": f"with {_offsets(_MERGE_SEGMENTS, 4, 1)} select * from offsets",
        "segment_slice_offsets_pack": f"with recursive {_offsets(_PACK_SEGMENTS, 6, 5)} select * from offsets",
        "total_frames": f"""with {_offsets(_MERGE_SEGMENTS, 4, 1)}
select segment_id, trunc((end_sample - start_sample)::double / 24000::double * 50::double)::bigint frames from offsets""",
        "sliced_samples": f"with {_SAMPLES} select segment_id, {_TEXT.format('token_ids[3:n - 2]')} samples from f2",
        "frame_gaps": f"""with {_SAMPLES}
select segment_id,
  {_TEXT.format("list_transform(range(1, n + 1), lambda i: greatest(0, case when i = 1 then positions[1] else positions[i] - positions[i - 1] - 1 end))")} f_before,
  {_TEXT.format("list_transform(range(1, n + 1), lambda i: greatest(0, case when i = n then duration_frames - 1 - positions[i] else positions[i + 1] - positions[i] - 1 end))")} f_after
from f2""",
        "position_diffs": f"""with {_J} select segment_id, {_TEXT.format('steps')} steps, coalesce(list_max(steps), -1) largest,
coalesce(list_max(steps) > 150, false) is_large from judged""",
        "run_length_flag": f"""with {_SAMPLES} select segment_id, len(list_filter(range(1, n - 2),
lambda i: positions[i] = positions[i + 1] and positions[i] = positions[i + 2] and positions[i] = positions[i + 3])) > 0 has_run from f2""",
        "trimmed_tokens": f"with {_SAMPLES} select segment_id, (case when vec_id % 7 <> 0 then n // 2 else n end)::bigint n_tokens from f2",
        "token_batches": f"""with {_BATCHED.format(size=3)} select segment_id, batch, n::bigint length, longest::bigint longest,
{_TEXT.format('list_concat(token_ids, list_transform(range(0, longest - n), lambda i: 0::bigint))')} token_ids from lb""",
        "padded_waveforms": f"with {_BATCHED.format(size=64)} select segment_id, batch, longest::bigint n_padded, n::bigint length from lb",
        "channel_mean": """select vec_id, array_to_string(list_transform(range(1, 33),
lambda i: round(embedding[i]::double * 1000)::bigint + round(embedding[i + 32]::double * 1000)::bigint), ',') doubled_mean
from embeddings where len(embedding) = 64""",
        "snake_activation": """select vec_id, round(a + pow(sin(0.5::double * a), 2) / (0.5::double + 1e-9::double), 6) "first",
round(b + pow(sin(0.5::double * b), 2) / (0.5::double + 1e-9::double), 6) "last"
from (select vec_id, embedding[1]::double a, embedding[len(embedding)]::double b from embeddings)""",
        "quality_reason_merge": f"with {_J} select segment_id, reason from judged",
        "quality_reason_pack": f"with {_judged('5::double')} select segment_id, reason from judged",
        "manifest": f"""with {_J} select segment_id, dataset, num_tokens, duration_frames, feature_path,
regexp_replace(segment_id, '_[^_]*$', '') recording_id from manifest""",
        "rejection_stats": f"""with {_J}, r as (select coalesce(reason, 'kept') reason, count(*) n from judged group by 1)
select reason, n, n::double / (sum(n) over ())::double * 100 pct, (sum(n) over ())::bigint total from r""",
        "manifest_totals": f"""with {_J} select count(*) n_segments, coalesce(sum(duration_frames), 0)::double / 50::double / 3600::double as "hours",
coalesce(sum(num_tokens), 0)::bigint tokens from manifest""",
        "transcripts_nonempty": r"""select printf('c%d_%04d', conv_id, turn) segment_id, 'c' || conv_id recording_id, turn idx,
regexp_replace(text, '^\s+|\s+$', '', 'g') text from conversations
where turn % 5 <> 3 and regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''""",
        "segments_with_text": r"""select 'c' || conv_id recording_id, turn idx, regexp_replace(text, '^\s+|\s+$', '', 'g') text from conversations
where turn % 5 <> 3 and regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''""",
        "name_parts": f"""with {_REMOTE} select key, name, replace(name, '.mp3', '') stem, recording_id,
recording_id || '_' || (length(key) * 100)::varchar segment_id, recording_id of_segment, true is_public from remote""",
        "listed_recordings": f"with {_REMOTE} select name, size from remote",
        "resume_todo": f"""with {_REMOTE} select recording_id, name from remote
where recording_id not in (select doc_id::varchar from labels where doc_id is not null)""",
        "done_totals": "select count(*) n_recordings, coalesce(sum(quality), 0)::bigint n_segments from labels",
        "file_collisions": "select source recording_id, count(*) n_files from documents group by source having count(*) > 1",
        "stale_partials": f"""with {_SAMPLES} select segment_id, recording_id from f2
where recording_id in (select recording_id from f2 where vec_id % 5 = 0)""",
        "done_after_run": f"""with recursive {_PACK_SEGMENTS},
n as (select recording_id, count(*) n from segments group by recording_id)
select r.recording_id::varchar recording_id, coalesce(n, 0) n_segments, 'ok' status
from (select distinct recording_id from vad) r left join n on n.recording_id = r.recording_id""",
        "download_plan": f"with {_REMOTE} select * from plan",
        "download_summary": f"""with {_REMOTE} select count(*) n_objects, sum(size)::double / 1048576::double total_mb,
(select count(*) from plan) n_copy, count(*) - (select count(*) from plan) n_skip from remote""",
        "transfer_counts": """select count_if(doc_id % 10 <> 0 and doc_id % 3 <> 0)::bigint n_ok, count_if(doc_id % 10 <> 0 and doc_id % 3 = 0)::bigint n_skip,
count_if(doc_id % 10 = 0)::bigint n_error from documents""",
        "upload_candidates": f"with {_UPLOAD} select * from candidates",
        "upload_plan": f"""with {_UPLOAD} select * from candidates c
where not exists (select 1 from idx where idx.key = c.key and idx.size = c.local_size)""",
        "human_duration": f"""with {_VAD}, m as (select recording_id, floor(max(e) * 37::double)::bigint t from vad group by recording_id)
select recording_id, case when t >= 3600 then printf('%dh %dm %ds', t // 3600, t % 3600 // 60, t % 60)
when t >= 60 then printf('%dm %ds', t // 60, t % 60) else printf('%ds', t) end took from m""",
        "time_left": """select doc_id, case when doc_id % 100 > 0 then round(n_chars::double / ((doc_id % 100) / 100::double) - n_chars::double, 6) end left_s
from documents""",
        "split_hash": f"with {_J} select recording_id, pos, split from split",
        "split_summary": f"""with {_J} select split, sum(duration_frames)::double / 50::double / 3600::double as "hours",
count(distinct recording_id) n_recordings, count(*) n_segments from assigned group by split""",
        "split_disjoint": f"""with {_J} select recording_id from assigned where split = 'train'
intersect select recording_id from assigned where split = 'val'""",
        "verify_sample": f"""with {_J}, r as (select split, segment_id,
row_number() over (partition by split order by md5('123:' || segment_id), segment_id) nth from assigned)
select split, segment_id from r where nth <= 5""",
        "verify_keys_shapes": f"with {_CHECKS} select * from checked",
        "verify_results": f"with {_CHECKS} select * from results",
        "verify_overall": f"with {_CHECKS} select coalesce(bool_and(passed), true) passed from results",
        "incomplete_samples": f"""with {_SAMPLES} select segment_id, concat_ws(',', case when vec_id % 13 = 0 then 'encoder_features' end,
case when vec_id % 3 = 0 then 'positions' end) missing from f2""",
    }
