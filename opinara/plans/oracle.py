"""The registered queries in SQL, for a second engine over the same tables."""

from __future__ import annotations

from opinara.functions.lexicon import DOWN, UP

AS_OF = "timestamp '2024-01-31 00:00:00'"
CUT = "timestamp '2024-01-15 00:00:00'"
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def shown(expr: str) -> str:
    return f"strftime({expr}, {STAMP})"


def words(items: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in items)


def balance(text: str) -> str:
    tokens = f"string_split(lower({text}), ' ')"
    return (
        f"(len(list_filter({tokens}, lambda w: w in ({words(UP)})))"
        f" - len(list_filter({tokens}, lambda w: w in ({words(DOWN)}))))"
    )


def three(score: str) -> str:
    return f"case when {score} > 0 then 'LABEL_2' when {score} < 0 then 'LABEL_0' else 'LABEL_1' end"


def stars(score: str) -> str:
    n = f"greatest(1, least(5, {score} + 3))"
    return f"case when {n} = 1 then '1 star' else {n} || ' stars' end"


def mood(raw: str) -> str:
    return (
        f"case when {raw} in ('LABEL_0', 'negative', '1 star', '2 stars') then 'negative'"
        f" when {raw} in ('LABEL_2', 'positive', '4 stars', '5 stars') then 'positive'"
        f" else 'neutral' end"
    )


VIEWS = f"""
comments_plain as (
  select event_id, 'c' || event_id as comment_id, 'v' || user_id as video_id,
         case when event_id % 17 = 0 then null else cast(floor(value) as int) end as likes,
         ts as published_at,
         case when event_id % 5 = 0 then ts + interval 1 hour else ts end as updated_at,
         case event_type when 'error' then 'LABEL_0' when 'view' then 'LABEL_1'
              when 'purchase' then 'LABEL_2' when 'click' then 'positive' else 'signup' end as raw_label_1,
         case when (event_id * 7 + user_id) % 5 = 0 then '1 star'
              else ((event_id * 7 + user_id) % 5 + 1) || ' stars' end as raw_label_2,
         case when event_id % 10 = 9 then null when event_id % 3 = 0 then 'n'
              when event_id % 3 = 1 then 'ne' else 'p' end as human_code
  from events
),
comments_raw as (
  select c.*, d.text, d.doc_id from comments_plain c
  join documents d on d.doc_id = c.event_id % (select count(*) from documents)
),
videos_raw as (
  select 'v' || user_id as video_id, 'ch' || (user_id % 25) as channel_id,
         case when user_id % 13 = 0 then '' else text end as video_title,
         case when user_id % 23 = 22 then null
              else {AS_OF} - to_days(cast(user_id % 20 as int)) end as date_publication,
         case when user_id % 7 = 6 then 0 else 1 end as is_active,
         cast(null as timestamp) as last_checked_at,
         case when user_id % 4 = 0 then 'positive' end as video_title_sentiment,
         user_id
  from (select distinct user_id from events) u
  join documents d on d.doc_id = user_id % (select count(*) from documents)
),
counts_now as (
  select 'v' || user_id as video_id,
         case when user_id % 3 = 0 then count(case when ts < {CUT} then 1 end) else count(*) end as yt_count
  from events group by user_id having arg_max(event_type, event_id) <> 'signup'
),
by_label as (
  select c.* exclude (likes), coalesce(likes, 0) as likes, 1 as model_id, {mood("raw_label_1")} as sentiment_label
  from comments_plain c
  union all
  select c.* exclude (likes), coalesce(likes, 0) as likes, 2 as model_id, {mood("raw_label_2")} as sentiment_label
  from comments_plain c
),
raw_stored as (
  select b.*, d.text as comment_text from by_label b
  join documents d on d.doc_id = b.event_id % (select count(*) from documents)
),
deltas as (
  select video_id, model_id, case when published_at < {CUT} then 1 else 2 end as batch_id,
         cast(count(*) filter (where sentiment_label = 'positive') as bigint) as pos_count,
         cast(count(*) filter (where sentiment_label = 'negative') as bigint) as neg_count,
         cast(count(*) filter (where sentiment_label = 'neutral') as bigint) as neu_count,
         cast(sum(likes) as bigint) as total_likes,
         cast(count(*) as bigint) as total_comments,
         max(published_at) as last_sync_date
  from by_label group by all
),
stats_first as (select * from deltas where batch_id = 1),
stats_now as (
  select video_id, model_id,
         case when min(batch_id) = 1 then 'positive' end as video_title_sentiment,
         cast(sum(pos_count) as bigint) as pos_count, cast(sum(neg_count) as bigint) as neg_count,
         cast(sum(neu_count) as bigint) as neu_count, cast(sum(total_likes) as bigint) as total_likes,
         arg_max(total_comments, batch_id) as total_comments,
         arg_max(last_sync_date, batch_id) as last_sync_date,
         case when min(batch_id) = 1 then {CUT} else {AS_OF} end as checked_at
  from deltas group by video_id, model_id
),
marks as (select video_id, max(last_sync_date) as last_sync_date from stats_first group by video_id),
top_rows as (
  select * from stats_now
  order by total_likes desc, total_comments desc, video_id, model_id limit 50
),
pivoted as (
  select comment_id, comment_text, likes, any_value(video_id) as video_id,
         max(case when model_id = 1 then sentiment_label end) as sentiment_model_1,
         max(case when model_id = 2 then sentiment_label end) as sentiment_model_2
  from raw_stored group by comment_id, comment_text, likes
),
frame as (
  select *, case when is_top then 'Top' else 'Bottom' end as pop_str,
         sentiment_model_1 || '_' || sentiment_model_2 || '_' || case when is_top then 'Top' else 'Bottom' end as strata
  from (
    select p.*, likes >= median(likes) over (partition by video_id) as is_top
    from pivoted p where video_id in (select video_id from top_rows)
  )
),
gold as (
  select comment_id, video_id, {mood("raw_label_1")} as sentiment_model_1,
         {mood("raw_label_2")} as sentiment_model_2,
         case human_code when 'n' then 'negative' when 'ne' then 'neutral' when 'p' then 'positive' end as human_sentiment
  from comments_plain
),
gold_full as (select * from gold where human_sentiment is not null),
pairs as (
  select 'sentiment_model_1' as model, human_sentiment as human, sentiment_model_1 as predicted from gold_full
  union all
  select 'sentiment_model_2', human_sentiment, sentiment_model_2 from gold_full
),
blocked as (
  select 'v' || user_id as video_id from events group by user_id having arg_max(event_type, event_id) = 'error'
),
found as (
  select 'v' || doc_id as video_id, text as title, 'ch' || (doc_id % 40) as channel_id,
         'channel ' || (doc_id % 40) as channel_name,
         {AS_OF} - to_hours(cast(doc_id % 97 as int)) as published_at
  from documents where lang <> 'de'
),
users as (select count(distinct user_id) as n from events),
added as (
  select * exclude (place) from (
    select *, row_number() over (order by published_at desc, video_id) as place from found)
  where place <= (select greatest(0, (select n from users) - count(*)) from videos_raw where is_active = 1)
),
identified as (
  select *, case when event_id % 4 = 0 then cast(event_id % 3 + 1 as varchar) else event_type end as identifier
  from events
),
registered as (
  select 1 as model_id, 'view' as model_name where exists (select 1 from events where event_type = 'view')
  union all
  select 5, 'click' where exists (select 1 from events where event_type = 'click')
),
registry as (
  select model_id, model_name, {CUT} as date_from from registered
  union all
  select cast((select max(model_id) from registered) + row_number() over (order by first_seen, identifier) as int),
         identifier, {AS_OF}
  from (select identifier, min(event_id) as first_seen from identified
        where event_id % 4 <> 0 and identifier not in (select model_name from registered) group by identifier)
),
document_score as (select doc_id, {balance("text")} as score from documents),
wave_labels as (
  select b.video_id, b.comment_id, b.published_at, coalesce(b.likes, 0) as likes, m.model_id,
         case m.model_id when 1 then {mood(three("s.score"))} else {mood(stars("s.score"))} end as sentiment_label
  from comments_raw b join document_score s on s.doc_id = b.doc_id
  cross join (select unnest([1, 2]) as model_id) m
),
counts_first as (
  select 'v' || user_id as video_id, count(*) as yt_count from events where ts < {CUT} group by user_id
),
decided_first as (
  select v.video_id, c.yt_count,
         case when v.date_publication is null then 'skip_no_date'
              when floor(date_diff('microsecond', v.date_publication, {CUT}) / 86400000000.0) > 14 then 'deactivate_old'
              when c.yt_count is null then 'skip_no_count'
              when floor(date_diff('microsecond', v.date_publication, {CUT}) / 86400000000.0) > 3 and c.yt_count <= 0 then 'deactivate_quiet'
              else 'fetch' end as action
  from videos_raw v left join counts_first c using (video_id) where v.is_active = 1
),
wave_first as (
  select f.video_id, f.model_id, f.yt_count as total_comments,
         cast(count(w.comment_id) filter (where sentiment_label = 'positive') as bigint) as pos_count,
         cast(count(w.comment_id) filter (where sentiment_label = 'negative') as bigint) as neg_count,
         cast(count(w.comment_id) filter (where sentiment_label = 'neutral') as bigint) as neu_count,
         cast(coalesce(sum(w.likes), 0) as bigint) as total_likes, max(w.published_at) as last_sync_date
  from (select *, unnest([1, 2]) as model_id from decided_first where action = 'fetch') f
  left join wave_labels w on w.video_id = f.video_id and w.model_id = f.model_id and w.published_at < {CUT}
  group by f.video_id, f.model_id, f.yt_count
),
wave_marks as (
  select video_id, max(last_sync_date) as last_sync_date, max(total_comments) as total_comments
  from wave_first group by video_id
),
still_active as (
  select v.* from videos_raw v left join decided_first d using (video_id)
  where v.is_active = 1 and coalesce(d.action, '') not like 'deactivate%'
),
decided_second as (
  select v.video_id, coalesce(c.yt_count, m.total_comments, 0) as yt_count, m.last_sync_date,
         case when v.date_publication is null then 'skip_no_date'
              when floor(date_diff('microsecond', v.date_publication, {AS_OF}) / 86400000000.0) > 14 then 'deactivate_old'
              when c.yt_count is null and u.video_id is null then 'skip_no_count'
              when floor(date_diff('microsecond', v.date_publication, {AS_OF}) / 86400000000.0) > 3
                   and c.yt_count <= coalesce(m.total_comments, 0) and u.video_id is null then 'deactivate_quiet'
              when v.video_id in (select video_id from blocked) then 'deactivate_disabled'
              else 'fetch' end as action
  from still_active v left join counts_now c using (video_id) left join wave_marks m using (video_id)
  left join (select distinct video_id from comments_plain where published_at >= {CUT}) u using (video_id)
),
wave_second as (
  select f.video_id, f.model_id, f.yt_count as total_comments,
         cast(count(w.comment_id) filter (where sentiment_label = 'positive') as bigint) as pos_count,
         cast(count(w.comment_id) filter (where sentiment_label = 'negative') as bigint) as neg_count,
         cast(count(w.comment_id) filter (where sentiment_label = 'neutral') as bigint) as neu_count,
         cast(coalesce(sum(w.likes), 0) as bigint) as total_likes,
         coalesce(max(w.published_at), any_value(f.last_sync_date)) as last_sync_date
  from (select *, unnest([1, 2]) as model_id from decided_second where action = 'fetch') f
  left join wave_labels w on w.video_id = f.video_id and w.model_id = f.model_id
       and w.published_at >= {CUT} and w.published_at > coalesce(f.last_sync_date, timestamp '1900-01-01 00:00:00')
  group by f.video_id, f.model_id, f.yt_count
),
wave_stats as (
  select video_id, model_id, cast(null as varchar) as video_title_sentiment,
         cast(sum(pos_count) as bigint) as pos_count, cast(sum(neg_count) as bigint) as neg_count,
         cast(sum(neu_count) as bigint) as neu_count, cast(sum(total_likes) as bigint) as total_likes,
         arg_max(total_comments, batch_id) as total_comments,
         arg_max_null(last_sync_date, batch_id) as last_sync_date,
         case when min(batch_id) = 1 then {CUT} else {AS_OF} end as checked_at
  from (select *, 1 as batch_id from wave_first union all by name select *, 2 as batch_id from wave_second)
  group by video_id, model_id
),
wave_added as (
  select * exclude (place) from (
    select *, row_number() over (order by published_at desc, video_id) as place from found)
  where place <= (select greatest(0, (select n from users) - count(*)) from decided_second where action not like 'deactivate%')
),
wave_known as (
  select v.video_id, v.channel_id, v.video_title, v.date_publication,
         case when coalesce(a.action, '') like 'deactivate%' or coalesce(b.action, '') like 'deactivate%'
              then 0 else v.is_active end as is_active,
         case when b.action = 'fetch' then {AS_OF} when a.action = 'fetch' then {CUT} end as last_checked_at,
         coalesce(v.video_title_sentiment,
                  case when v.video_title = '' then 'neutral' else {mood(three("s.score"))} end) as video_title_sentiment
  from videos_raw v left join decided_first a using (video_id) left join decided_second b using (video_id)
  join document_score s on s.doc_id = v.user_id % (select count(*) from documents)
),
wave_videos as (
  select coalesce(k.video_id, f.video_id) as video_id, coalesce(f.channel_id, k.channel_id) as channel_id,
         coalesce(f.title, k.video_title) as video_title,
         coalesce(f.published_at, k.date_publication) as date_publication,
         case when f.video_id is not null then 1 else k.is_active end as is_active,
         case when f.video_id is not null then {AS_OF} else k.last_checked_at end as last_checked_at,
         k.video_title_sentiment
  from wave_known k full outer join wave_added f on f.video_id = k.video_id
)
"""

VIDEO = f"""video_id, channel_id, md5(video_title) as video_title,
  {shown("date_publication")} as date_publication, is_active,
  {shown("last_checked_at")} as last_checked_at, video_title_sentiment"""
COUNTERS = "pos_count, neg_count, neu_count, total_likes, total_comments"
FRAME = """comment_id, md5(comment_text) as comment_text, likes, video_id, sentiment_model_1,
  sentiment_model_2, is_top, pop_str, strata"""
TOTALS = """cast(coalesce(sum(pos_count), 0) as bigint) as total_positive,
  cast(coalesce(sum(neg_count), 0) as bigint) as total_negative,
  cast(coalesce(sum(neu_count), 0) as bigint) as total_neutral,
  cast(coalesce(sum(total_likes), 0) as bigint) as total_likes,
  cast(coalesce(sum(total_comments), 0) as bigint) as total_comments,
  cast(count(video_id) as bigint) as total_videos"""

FIRST_SAMPLE = """
  sizes as (select strata, count(*) as n from frame where strata is not null group by strata),
  shares as (
    select strata, n * 300 // (select sum(n) from sizes) as base, n * 300 % (select sum(n) from sizes) as rest
    from sizes),
  quotas as (
    select strata, base + case when row_number() over (order by rest desc, strata)
                                <= 300 - (select sum(base) from shares) then 1 else 0 end as quota
    from shares),
  placed as (
    select f.*, row_number() over (partition by strata
             order by md5('42-' || comment_id), comment_id, comment_text, likes) as place
    from frame f where strata is not null)
"""

REPORT = """
  sides as (
    select model, human as label, count(*) as support, 0 as predicted,
           count(*) filter (where human = predicted) as hits from pairs group by model, human
    union all
    select model, predicted, 0, count(*), 0 from pairs group by model, predicted),
  classes as (
    select model, label, sum(support) as support, sum(predicted) as predicted, sum(hits) as hits
    from sides group by model, label),
  ratios as (
    select model, label, case when predicted > 0 then hits / predicted else 0 end as precision,
           case when support > 0 then hits / support else 0 end as recall,
           case when predicted + support > 0 then 2 * hits / (predicted + support) else 0 end as f1_score,
           support, hits from classes),
  report as (
    select model, label, precision, recall, f1_score, support from ratios
    union all
    select model, 'accuracy', null, null, sum(hits) / sum(support), sum(support) from ratios group by model
    union all
    select model, 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) from ratios group by model
    union all
    select model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
           sum(f1_score * support) / sum(support), sum(support) from ratios group by model)
"""



def with_ids(groups: str) -> str:
    """Views that number the model identifiers of ``grouped`` in order of its rows."""
    return f"""
  grouped as ({groups}),
  numbered as (
    select identifier, cast(row_number() over (order by min(row_order), identifier)
                            + (select max(model_id) from registered) as int) as model_id
    from grouped where not regexp_full_match(identifier, '[0-9]+')
      and identifier not in (select model_name from registered) group by identifier),
  grouped_ids as (
    select g.*, coalesce(try_cast(g.identifier as int), r.model_id, n.model_id) as model_id
    from grouped g left join registered r on r.model_name = g.identifier
    left join numbered n on n.identifier = g.identifier)
"""


STORED = f"""comment_id, model_id, video_id, md5(text) as comment_text, likes,
  {shown("published_at")} as published_at, sentiment_label, false as score_failed"""
WAVE_COMMENTS = f"""wave_comments as (
  select w.*, c.text from wave_labels w join (select comment_id, text from comments_raw) c using (comment_id)
  where (published_at < {CUT} and video_id in (select video_id from decided_first where action = 'fetch'))
     or (published_at >= {CUT} and video_id in (select video_id from decided_second where action = 'fetch')))"""


# Name: (further views, statement).
# Everything of the videos that are watched, have a date and so are read, and of those found again.
ALL_READ = f"""select video_id, model_id,
  cast(count(*) filter (where sentiment_label = 'positive') as bigint) as pos_count,
  cast(count(*) filter (where sentiment_label = 'negative') as bigint) as neg_count,
  cast(count(*) filter (where sentiment_label = 'neutral') as bigint) as neu_count,
  cast(sum(likes) as bigint) as total_likes, {shown("max(published_at)")} as last_sync_date
  from wave_labels join videos_raw using (video_id) where is_active = 0 or date_publication is not null
  group by video_id, model_id"""

STATEMENTS: dict[str, tuple[str, str]] = {
    "prepare_comments": (
        "",
        f"""select video_id, comment_id,
          md5(case when event_id % 4 <> 0 then text when event_id % 8 = 0 then text else '' end) as comment_text,
          case when event_id % 29 = 0 then 0 else coalesce(likes, 0) end as likes,
          {shown("published_at")} as published_at,
          case when event_id % 11 = 0 then true else published_at <> updated_at end as is_edited,
          case when event_id % 3 = 0 then raw_label_1 else raw_label_2 end as sentiment_label
          from comments_raw where event_id % 49 <> 0 and event_id % 19 <> 0""",
    ),
    "parse_times": (
        "",
        f"""select event_id, case event_id % 9
            when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
            when 1 then strftime(ts + interval 2 hours, '%Y-%m-%dT%H:%M:%S+02:00')
            when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S')
            when 3 then strftime(ts, '%Y-%m-%d')
            when 4 then strftime(ts - interval 5 hours, '%Y-%m-%dT%H:%M:%S-0500')
            when 5 then strftime(ts, '%H:%M')
            when 6 then strftime(ts, '%Y')
            when 7 then 'on ' || strftime(ts, '%Y-%m-%d') end as written,
          {shown('''case event_id % 9 when 0 then ts when 1 then date_trunc('second', ts)
            when 2 then date_trunc('second', ts) when 3 then date_trunc('day', ts)
            when 4 then date_trunc('second', ts) end''')} as parsed
          from events""",
    ),
    "normalize_labels": (
        "",
        f"""select comment_id, {mood("raw_label_1")} as label_1, {mood("raw_label_2")} as label_2
          from comments_plain""",
    ),
    "new_comments": (
        "",
        f"""select c.video_id, comment_id, likes, {shown("published_at")} as published_at
          from comments_plain c left join marks m using (video_id)
          where published_at > coalesce(last_sync_date, timestamp '1900-01-01 00:00:00')""",
    ),
    "newest_per_video": (
        "",
        f"""select video_id, comment_id, likes, {shown("published_at")} as published_at, rn
          from (select *, row_number() over (partition by video_id order by published_at desc, comment_id) as rn
                from comments_plain) where rn <= 20""",
    ),
    "upsert_comments": (
        "",
        f"""select comment_id, model_id, video_id, {shown("published_at")} as published_at,
          md5(case when sentiment_label <> 'neutral' then comment_text || ' edited' else comment_text end) as comment_text,
          case when sentiment_label <> 'neutral' then likes + 1 else likes end as likes,
          case when sentiment_label = 'neutral' or event_id % 2 = 1 then 'neutral'
               when sentiment_label = 'positive' then 'negative' else 'positive' end as sentiment_label
          from raw_stored""",
    ),
    "drop_redelivered": (
        "",
        """select * exclude (place) from (
          select *, row_number() over (partition by comment_id order by page desc, position desc, video_id desc, likes desc) as place
          from (select comment_id, video_id, coalesce(likes, 0) as likes, event_id % 3 as page, event_id % 5 as position
                from comments_plain
                union all select comment_id, video_id, coalesce(likes, 0) + 5, 1, event_id % 5 from comments_plain
                union all select comment_id, video_id, coalesce(likes, 0) + 9, event_id % 3, 2 from comments_plain))
          where place = 1""",
    ),
    "video_mood": (
        "",
        f"""select video_id, model_id,
          cast(count(*) filter (where sentiment_label = 'positive') as bigint) as pos_count,
          cast(count(*) filter (where sentiment_label = 'negative') as bigint) as neg_count,
          cast(count(*) filter (where sentiment_label = 'neutral') as bigint) as neu_count,
          cast(sum(likes) as bigint) as total_likes, {shown("max(published_at)")} as last_sync_date
          from by_label group by video_id, model_id""",
    ),
    "upsert_video_stats": (
        "",
        f"""select video_id, model_id, video_title_sentiment, {COUNTERS},
          {shown("last_sync_date")} as last_sync_date, {shown("checked_at")} as checked_at from stats_now""",
    ),
    "zero_delta": (
        "",
        f"""select c.video_id, c.model_id, cast(null as varchar) as video_title_sentiment,
          coalesce(d.pos_count, 0) as pos_count, coalesce(d.neg_count, 0) as neg_count,
          coalesce(d.neu_count, 0) as neu_count, coalesce(d.total_likes, 0) as total_likes,
          c.yt_count as total_comments,
          {shown("coalesce(d.last_sync_date, m.last_sync_date)")} as last_sync_date,
          {shown(AS_OF)} as checked_at, cast(2 as bigint) as batch_id
          from (select *, unnest([1, 2, 3]) as model_id from counts_now) c
          left join (select * from deltas where batch_id = 2) d
            on d.video_id = c.video_id and d.model_id = c.model_id
          left join marks m on m.video_id = c.video_id""",
    ),
    "latest_stats": (
        "",
        f"""select video_id, model_id, {COUNTERS}, case when batch_id = 1 then 'positive' end as video_title_sentiment,
          {shown("last_sync_date")} as last_sync_date,
          {shown(f"case when batch_id = 1 then {CUT} else {AS_OF} end")} as checked_at,
          cast(batch_id as bigint) as batch_id
          from (select *, row_number() over (partition by model_id, video_id order by batch_id desc) as rn from deltas)
          where rn = 1""",
    ),
    "global_snapshot": (
        "",
        f"""select m.model_id, {TOTALS}, {shown(AS_OF)} as snapshot_date
          from (select unnest([1, 2, 3]) as model_id) m left join stats_now s on s.model_id = m.model_id
          group by m.model_id""",
    ),
    "stats_of_model": (
        "",
        f"""select video_id, model_id, video_title_sentiment, {COUNTERS},
          {shown("last_sync_date")} as last_sync_date, {shown("checked_at")} as checked_at
          from stats_now where model_id = 2""",
    ),
    "top_videos": ("", "select video_id, model_id, total_likes, total_comments from top_rows"),
    "top_video_comments": (
        "",
        """select comment_id, video_id, model_id, sentiment_label, likes from by_label
          where video_id in (select video_id from top_rows)""",
    ),
    "active_videos": (
        "",
        f"""select v.video_id, {shown("date_publication")} as date_publication,
          coalesce(total_comments, 0) as total_comments
          from videos_raw v left join (select video_id, max(total_comments) as total_comments
                                       from stats_first group by video_id) s using (video_id)
          where is_active = 1""",
    ),
    "active_videos_fanout": (
        "",
        f"""select v.video_id, {shown("date_publication")} as date_publication,
          coalesce(s.total_comments, 0) as total_comments
          from videos_raw v left join stats_first s on v.video_id = s.video_id where v.is_active = 1""",
    ),
    "platform_counts": (
        "",
        """select v.video_id, channel_id, yt_count from videos_raw v
          left join counts_now using (video_id) where is_active = 1""",
    ),
    "video_lifecycle": (
        """aged as (
            select v.video_id, date_publication, coalesce(m.total_comments, 0) as total_comments, c.yt_count,
                   cast(floor(date_diff('microsecond', date_publication, timestamp '2024-01-31 00:00:00')
                              / 86400000000.0) as int) as age_days, l.last_sync_date
            from videos_raw v
            left join (select video_id, max(total_comments) as total_comments from stats_first group by video_id) m
              using (video_id)
            left join counts_now c using (video_id) left join marks l using (video_id)
            where is_active = 1)""",
        f"""select video_id, {shown("date_publication")} as date_publication, total_comments, yt_count, age_days,
          {shown("last_sync_date")} as last_sync_date,
          case when date_publication is null then 'skip_no_date' when age_days > 14 then 'deactivate_old'
               when yt_count is null then 'skip_no_count'
               when age_days > 3 and yt_count <= total_comments then 'deactivate_quiet' else 'fetch' end as action
          from aged""",
    ),
    "disabled_videos": (
        "",
        f"""select {VIDEO.replace("is_active", "case when video_id in (select video_id from blocked) then 0 else is_active end as is_active")}
          from videos_raw""",
    ),
    "stamp_videos": (
        "",
        f"""select {VIDEO.replace(shown("last_checked_at"), shown(f"case when video_id in (select video_id from counts_now) then {AS_OF} end"))}
          from videos_raw""",
    ),
    "free_slots": (
        "",
        f"""select video_id, md5(title) as title, channel_id, channel_name,
          {shown("published_at")} as published_at from added""",
    ),
    "free_slots_by_ranges": (
        "",
        f"""select video_id, md5(title) as title, channel_id, channel_name,
          {shown("published_at")} as published_at from added""",
    ),
    "register_videos": (
        """joined as (
            select coalesce(v.video_id, f.video_id) as video_id, coalesce(f.channel_id, v.channel_id) as channel_id,
                   coalesce(f.title, v.video_title) as video_title,
                   coalesce(f.published_at, v.date_publication) as date_publication,
                   case when f.video_id is not null then 1 else v.is_active end as is_active,
                   case when f.video_id is not null then timestamp '2024-01-31 00:00:00' end as last_checked_at,
                   v.video_title_sentiment
            from videos_raw v full outer join added f on f.video_id = v.video_id)""",
        f"select {VIDEO} from joined",
    ),
    "upsert_videos": (
        f"""changed as (
            select video_id, 'ch7' as channel_id, 'New ' || video_title as video_title,
                   case when user_id % 2 = 0 then {CUT} else date_publication end as date_publication,
                   1 - is_active as is_active,
                   case when user_id % 3 = 0 then {CUT} end as last_checked_at, video_title_sentiment
            from videos_raw)""",
        f"select {VIDEO} from changed",
    ),
    "upsert_channels": (
        "",
        """select coalesce(f.channel_id, n.channel_id) as channel_id,
          coalesce(f.channel_name, n.channel_name) as channel_name
          from (select 'ch' || n_nationkey as channel_id, n_name as channel_name from nation) n
          full outer join (select distinct channel_id, channel_name || ' b' as channel_name from found) f on f.channel_id = n.channel_id""",
    ),
    "titles_to_score": (
        "",
        "select video_id, md5(video_title) as video_title from videos_raw where video_title_sentiment is null",
    ),
    "backfill_titles": (
        f"""filled as (
            select v.* exclude (video_title_sentiment),
                   coalesce(video_title_sentiment, case when video_title = '' then 'neutral'
                            else {mood(three("s.score"))} end) as video_title_sentiment
            from videos_raw v join document_score s on s.doc_id = v.user_id % (select count(*) from documents))""",
        f"select {VIDEO} from filled",
    ),
    "model_registry": (
        "",
        f"select model_id, model_name, {shown('date_from')} as date_from from registry",
    ),
    "migrate_model_ids": (
        with_ids(
            """select 'v' || user_id as video_id, identifier, count(*) as pos_count,
                 count(*) filter (where value > 10) as neg_count, count(*) filter (where value > 20) as neu_count,
                 cast(sum(cast(floor(value) as bigint)) as bigint) as total_likes, count(*) as total_comments,
                 max(ts) as last_sync_date, min(ts) as checked_at, max(event_id) as row_order
               from identified group by user_id, identifier"""
        ),
        f"""select video_id, model_id, cast(null as varchar) as video_title_sentiment,
          {COUNTERS}, {shown("last_sync_date")} as last_sync_date, {shown("checked_at")} as checked_at
          from (select *, row_number() over (partition by video_id, model_id order by row_order desc) as rn
                from grouped_ids)
          where rn = 1""",
    ),
    "migrate_store": (
        with_ids(
            """select 'v' || user_id as video_id, identifier, count(*) as pos_count,
                 count(*) filter (where value > 10) as neg_count, count(*) filter (where value > 20) as neu_count,
                 cast(sum(cast(floor(value) as bigint)) as bigint) as total_likes, count(*) as total_comments,
                 max(ts) as last_sync_date, case when user_id % 5 <> 0 then min(ts) end as checked_at,
                 case when user_id % 5 <> 0 then min(ts) end as row_order
               from identified group by user_id, identifier"""
        ),
        f"""select video_id, model_id, cast(null as varchar) as video_title_sentiment,
          {COUNTERS}, {shown("last_sync_date")} as last_sync_date, {shown("checked_at")} as checked_at
          from (select *, row_number() over (partition by video_id, model_id order by checked_at desc nulls last,
                  pos_count desc, neg_count desc, neu_count desc, total_likes desc, total_comments desc,
                  last_sync_date desc) as rn
                from grouped_ids)
          where rn = 1""",
    ),
    "migrate_snapshots": (
        with_ids(
            """select identifier, date_trunc('day', ts) as day, count(*) as total_positive,
                 count(*) filter (where value > 10) as total_negative,
                 count(*) filter (where value > 20) as total_neutral,
                 cast(sum(cast(floor(value) as bigint)) as bigint) as total_likes,
                 count(distinct user_id) as total_videos, count(*) as total_comments, max(event_id) as row_order
               from identified group by identifier, date_trunc('day', ts)"""
        ),
        f"""select model_id, {shown("cast(day as timestamp)")} as snapshot_date, total_positive, total_negative,
          total_neutral, total_likes, total_videos, total_comments from grouped_ids""",
    ),
    "align_schema": (
        "",
        f"""select comment_id, cast(null as int) as model_id, video_id, md5(comment_text) as comment_text, likes,
          {shown("published_at")} as published_at, sentiment_label, cast(null as boolean) as score_failed
          from raw_stored""",
    ),
    "comments_by_model": (
        "",
        """select comment_id, video_id, case model_id when 1 then 'three-class' else 'five-star' end as model_name,
          sentiment_label, false as score_failed, model_id from wave_labels""",
    ),
    "lexicon_three_class": (
        "",
        f"""select doc_id, {three("score")} as raw_label, {mood(three("score"))} as mood from document_score""",
    ),
    "lexicon_five_star": (
        "",
        f"""select doc_id, {stars("score")} as raw_label, {mood(stars("score"))} as mood from document_score""",
    ),
    "score_with_model": (
        "",
        f"""select doc_id, 'py-three-class' as model_name, {mood(three("score"))} as sentiment_label,
          false as score_failed from document_score
          union all
          select doc_id, 'py-five-star', {mood(stars("score"))}, false from document_score""",
    ),
    "score_in_windows": (
        "",
        f"""select doc_id, 'py-three-class' as model_name, {mood(three("score"))} as sentiment_label,
          false as score_failed from document_score
          union all
          select doc_id, 'py-five-star', {mood(stars("score"))}, false from document_score""",
    ),
    "score_with_failures": (
        "",
        f"""select doc_id, 'unsteady' as model_name,
          case when length(text) % 7 < 2 then 'neutral' else {mood(three("score"))} end as sentiment_label,
          length(text) % 7 < 2 as score_failed from documents join document_score using (doc_id)""",
    ),
    "score_copies_once": (
        "",
        """select comment_id, case model_id when 1 then 'py-three-class' else 'py-five-star' end as model_name,
          sentiment_label, false as score_failed from wave_labels""",
    ),
    "score_store": (
        """asked as (select text, bool_or(event_id % 2 = 0) as early from comments_raw group by text),
          times as (select count(*) filter (where early) as scored_first,
                           count(*) filter (where not early) as scored_second from asked)""",
        """select comment_id, case model_id when 1 then 'py-three-class' else 'py-five-star' end as model_name,
          sentiment_label, false as score_failed, scored_first, scored_second from wave_labels, times""",
    ),
    "label_pivot": (
        "",
        """select comment_id, md5(comment_text) as comment_text, likes, video_id, sentiment_model_1,
          sentiment_model_2 from pivoted""",
    ),
    "video_median_likes": (
        "",
        """select comment_id, video_id, likes, median(likes) over (partition by video_id) as median_likes
          from comments_plain""",
    ),
    "annotation_frame": ("", f"select {FRAME} from frame"),
    "strata_counts": (
        "",
        "select strata, count(*) as n from frame where strata is not null group by strata",
    ),
    "stratified_sample": (
        FIRST_SAMPLE,
        f"""select {FRAME}, '' as human_sentiment, false as is_sarcasm
          from placed join quotas using (strata) where place <= quota""",
    ),
    "sample_preview": (
        FIRST_SAMPLE,
        f"""select {FRAME}, '' as human_sentiment, false as is_sarcasm
          from placed join quotas using (strata) where place <= quota order by strata, comment_id, likes limit 5""",
    ),
    "annotation_sheet_job": (
        FIRST_SAMPLE,
        f"""select {FRAME}, cast(null as varchar) as human_sentiment, false as is_sarcasm
          from placed join quotas using (strata) where place <= quota""",
    ),
    "sample_fallback": ("", f"select {FRAME} from frame"),
    "recode_annotations": (
        "",
        """select comment_id, case human_code when 'n' then 'negative' when 'ne' then 'neutral'
          when 'p' then 'positive' end as human_sentiment from comments_plain""",
    ),
    "gold_complete": ("", "select * from gold_full"),
    "label_columns": (
        "",
        """select count(sentiment_model_1) as sentiment_model_1, count(sentiment_model_2) as sentiment_model_2,
          count(human_sentiment) as human_sentiment from gold""",
    ),
    "confusion_all_labels": (
        """axis as (select model, human as label from pairs union select model, predicted from pairs)""",
        """select h.model, h.label as human, p.label as predicted, count(x.model) as n
          from axis h join axis p on p.model = h.model
          left join pairs x on x.model = h.model and x.human = h.label and x.predicted = p.label
          group by h.model, h.label, p.label""",
    ),
    "confusion_wide": (
        "",
        """select model, human, count(*) filter (where predicted = 'negative') as negative,
          count(*) filter (where predicted = 'neutral') as neutral,
          count(*) filter (where predicted = 'positive') as positive from pairs group by model, human""",
    ),
    "confusion_human_labels": (
        """two as (select * replace (case human when 'neutral' then 'negative' else human end as human) from pairs),
          axis as (select distinct model, human as label from two)""",
        """select h.model, h.label as human, p.label as predicted, count(x.model) as n
          from axis h join axis p on p.model = h.model
          left join two x on x.model = h.model and x.human = h.label and x.predicted = p.label
          group by h.model, h.label, p.label""",
    ),
    "classification_report": (
        REPORT,
        """select model, label, round(precision, 6) as precision, round(recall, 6) as recall,
          round(f1_score, 6) as f1_score, cast(support as bigint) as support from report""",
    ),
    "false_positives": (
        "",
        """select * from gold where sentiment_model_1 = 'positive' and sentiment_model_2 = 'positive'
          and human_sentiment = 'negative'""",
    ),
    "false_negatives": (
        "",
        """select * from gold where sentiment_model_1 = 'negative' and sentiment_model_2 = 'negative'
          and human_sentiment = 'positive'""",
    ),
    "disagreement_counts": (
        "",
        """select
          count(*) filter (where sentiment_model_1 = 'positive' and sentiment_model_2 = 'positive'
                           and human_sentiment = 'negative') as false_positives,
          count(*) filter (where sentiment_model_1 = 'negative' and sentiment_model_2 = 'negative'
                           and human_sentiment = 'positive') as false_negatives
          from gold""",
    ),
    "disagreement_counts_file": (
        "",
        """select
          count(*) filter (where sentiment_model_1 = 'positive' and sentiment_model_2 = 'positive'
                           and human_sentiment = 'negative') as false_positives,
          count(*) filter (where sentiment_model_1 = 'negative' and sentiment_model_2 = 'negative'
                           and human_sentiment = 'positive') as false_negatives
          from gold""",
    ),
    "disagreement_report": (
        "",
        """select md5(comment_text) as comment_text,
          case g.human_sentiment when 'negative' then 'false_positives' else 'false_negatives' end as kind
          from frame f join gold g on g.comment_id = f.comment_id
          where f.sentiment_model_1 = f.sentiment_model_2
            and ((f.sentiment_model_1 = 'positive' and g.human_sentiment = 'negative')
              or (f.sentiment_model_1 = 'negative' and g.human_sentiment = 'positive'))""",
    ),
    "read_comment_pages": (
        "",
        f"""select video_id, comment_id, md5(case when event_id % 4 <> 0 then text else '' end) as comment_text,
          coalesce(likes, 0) as likes, {shown("published_at")} as published_at,
          case when event_id % 2 = 0 then published_at <> updated_at else false end as is_edited
          from comments_raw where event_id % 19 <> 0 and event_id % 23 <> 0""",
    ),
    "read_search_pages": (
        "",
        f"""select video_id, md5(title) as title, channel_id, channel_name,
          {shown("published_at")} as published_at from found""",
    ),
    "read_count_pages": (
        "",
        "select video_id, case when yt_count % 10 <> 0 then yt_count else 0 end as yt_count from counts_now",
    ),
    "export_roundtrip": (
        "",
        f"""select comment_id, model_id, video_id, md5(comment_text) as comment_text, likes,
          {shown("published_at")} as published_at, sentiment_label, cast(null as boolean) as score_failed
          from raw_stored""",
    ),
    "export_videos": (
        # a CSV file does not tell an empty text from a missing one
        "exported as (select * replace (nullif(video_title, '') as video_title) from videos_raw)",
        f"select {VIDEO} from exported",
    ),
    "export_model_info": (
        "",
        f"select model_id, model_name, {shown('date_from')} as date_from from registry",
    ),
    "gold_roundtrip": (
        "",
        f"""select {FRAME.replace("comment_id,", "f.comment_id,").replace("video_id", "f.video_id").replace("sentiment_model_1", "f.sentiment_model_1").replace("sentiment_model_2", "f.sentiment_model_2")},
          g.human_sentiment, false as is_sarcasm from frame f join gold g on g.comment_id = f.comment_id""",
    ),
    "stream_cycle": (
        "",
        f"""select video_id, model_id, video_title_sentiment, {COUNTERS},
          {shown("last_sync_date")} as last_sync_date, {shown("checked_at")} as checked_at from wave_stats""",
    ),
    "stream_videos": ("", f"select {VIDEO} from wave_videos"),
    "stream_snapshots": (
        "",
        f"""select m.model_id, {TOTALS}, {shown(CUT)} as snapshot_date
          from (select unnest([1, 2]) as model_id) m left join wave_first s on s.model_id = m.model_id group by m.model_id
          union all
          select m.model_id, {TOTALS}, {shown(AS_OF)}
          from (select unnest([1, 2]) as model_id) m left join wave_stats s on s.model_id = m.model_id group by m.model_id""",
    ),
    "stream_comments": (WAVE_COMMENTS, f"select {STORED} from wave_comments"),
    "stream_channels": ("", "select distinct channel_id, channel_name from wave_added"),
    "stream_models": (
        WAVE_COMMENTS,
        f"""select model_id, case model_id when 1 then 'three-class' else 'five-star' end as model_name,
          {shown(CUT)} as date_from, count(*) as count from wave_comments group by model_id""",
    ),
    "stream_split_waves": (
        f"""kept as (
            select video_id, date_publication from videos_raw where is_active = 1 and date_publication is not null
              and floor(date_diff('microsecond', date_publication, {CUT}) / 86400000000.0) <= 14)""",
        f"""select {STORED} from (
            select w.*, true as stored from wave_labels w join kept using (video_id) where published_at < {CUT}
            union all
            select w.*, true from wave_labels w join kept k using (video_id) where published_at >= {CUT}
              and video_id not in (select video_id from blocked)
              and floor(date_diff('microsecond', k.date_publication, {AS_OF}) / 86400000000.0) <= 14)
          join (select comment_id, text from comments_raw) using (comment_id)""",
    ),
    "loadable_models": (
        "",
        """select case model_id when 1 then 'three-class' else 'five-star' end as model_name, sentiment_label,
          count(*) as n from wave_labels group by model_id, sentiment_label""",
    ),
    "stream_found_again": ("", ALL_READ),
    "stream_state_marks": ("", ALL_READ),
    "stream_late_comments": (
        # every fifth of the later comments came again, with 100 likes more and a text of one UP word
        f"""late_labels as (
            select video_id, model_id, published_at, likes + if(again, 100, 0) as likes,
                   if(again, 'positive', sentiment_label) as sentiment_label
            from (select *, published_at >= {CUT} and cast(substr(comment_id, 2) as bigint) % 5 = 0 as again
                  from wave_labels))""",
        ALL_READ.replace("wave_labels", "late_labels"),
    ),
    "replayed_batch": (
        "",
        f"""select video_id, model_id, cast(null as varchar) as video_title_sentiment, {COUNTERS},
          {shown("last_sync_date")} as last_sync_date, {shown(CUT)} as checked_at from wave_first""",
    ),
}
STATEMENTS["snapshot_from_delta"] = ("", f"select model_id, {TOTALS} from stats_now group by model_id")
STATEMENTS["export_global_sum"] = STATEMENTS["global_snapshot"]


def statements() -> dict[str, str]:
    """Complete SQL text per query."""
    return {
        name: f"with {VIEWS}{', ' + views if views.strip() else ''} {body}"
        for name, (views, body) in STATEMENTS.items()
    }
