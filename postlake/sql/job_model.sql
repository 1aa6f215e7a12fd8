-- The rules of the job model in plain values: what the queries' SQL starts with, after the tables. Nothing here is made from the package's own constants.
u0 as (select * exclude (k), nullif(lower(trim(regexp_replace(coalesce(posted_time_ago, ''), '^\s*published:\s*', '', 'i'))), '') as norm from star_jobs left join star_details using (platform, job_id)),
u1 as (select *, case when regexp_matches(norm, '^([0-9]+)\s+(minutes?|hours?|days?|weeks?|months?|years?)\s+ago$') then 'en' when regexp_matches(norm, '^vor\s+([0-9]+)\s+(minuten|stunden|monaten|minute|stunde|wochen|jahren|tagen|woche|monat|jahr|tag)$') then 'de' end as lg from u0),
u2 as (select *, cast(case lg when 'en' then regexp_extract(norm, '^([0-9]+)\s+(minutes?|hours?|days?|weeks?|months?|years?)\s+ago$', 1) when 'de' then regexp_extract(norm, '^vor\s+([0-9]+)\s+(minuten|stunden|monaten|minute|stunde|wochen|jahren|tagen|woche|monat|jahr|tag)$', 1) end as integer) as n,
  case lg when 'en' then regexp_extract(norm, '^([0-9]+)\s+(minutes?|hours?|days?|weeks?|months?|years?)\s+ago$', 2) when 'de' then regexp_extract(norm, '^vor\s+([0-9]+)\s+(minuten|stunden|monaten|minute|stunde|wochen|jahren|tagen|woche|monat|jahr|tag)$', 2) end as u from u1),
uni as (select *, platform = 'xing' and native_posted_at_utc is not null as native,
  case when platform = 'xing' and native_posted_at_utc is not null then native_posted_at_utc when norm in ('today', 'heute', 'just now', 'gerade eben') then scraped_at when norm in ('yesterday', 'gestern') then scraped_at - interval 1 day
    when lg is not null then scraped_at - to_months(12 * (case u when 'year' then 1 * n when 'years' then 1 * n when 'jahr' then 1 * n when 'jahren' then 1 * n else 0 end) + (case u when 'month' then 1 * n when 'months' then 1 * n when 'monat' then 1 * n when 'monaten' then 1 * n else 0 end)) - to_days(case u when 'day' then 1 * n when 'days' then 1 * n when 'week' then 7 * n when 'weeks' then 7 * n when 'tag' then 1 * n when 'tagen' then 1 * n when 'woche' then 7 * n when 'wochen' then 7 * n else 0 end) - to_hours(case u when 'hour' then 1 * n when 'hours' then 1 * n when 'stunde' then 1 * n when 'stunden' then 1 * n else 0 end) - to_minutes(case u when 'minute' then 1 * n when 'minutes' then 1 * n when 'minuten' then 1 * n else 0 end) end as posted_at_utc from u2),
uno as (select *, case when native then 'native_xing_posted_at_utc' when norm is null then 'missing_input' when norm in ('today', 'heute', 'just now', 'gerade eben', 'yesterday', 'gestern') then 'parsed_keyword' when lg is not null then 'parsed_relative_' || lg else 'unparsed_format' end as posted_at_source,
  case when native then 'posted_at_utc' when norm is null then 'missing_input' else coalesce(u, norm) end as posted_at_parse_detail, posted_at_utc is not null as posted_at_parse_ok, coalesce(posted_at_utc, first_seen_at) as event_ts from uni),
skill as (select platform, job_id, event_ts, s from (select platform, job_id, event_ts, extracted_skills as x, unnest(json_keys(coalesce(extracted_skills, '{}'))) as g from uno) q, unnest(case when json_type(x, '$.' || g) = 'ARRAY' then cast(json_extract(x, '$.' || g) as varchar[]) else cast([] as varchar[]) end) as t(s)),
r0 as (select * replace (case when platform in ('linkedin', 'xing') then nullif(trim(employment_type), '') end as employment_type, nullif(trim(contract_type), '') as contract_type, nullif(trim(work_type), '') as work_type) from uno),
r1 as (select *, case when platform = 'stepstone' then part_time when employment_type is not null then lower(employment_type) in ('part-time', 'part time') end as part_time_flag, lower(coalesce(job_title, '')) as ti, lower(coalesce(job_description, '')) as de, lower(coalesce(employment_type, '')) as em,
  lower(concat_ws(' | ', employment_type, contract_type, work_type)) as st from r0),
r2 as (select *, regexp_matches(st, '(?:^|[^\p{L}\p{N}_])(?:werkstudent(?:[:*/._-]?in|en|entätigkeit)?|studentenjobs?|student job|working[ -]?student|student assistant|student employee|student worker|student(?:ische|ischer|isches)?[ -]+(?:hilfskraft|aushilfe|mitarbeiter(?:[:*/._-]?in)?)|industrial placement student)(?:$|[^\p{L}\p{N}_])') as ws_s, platform = 'xing' and em in ('student', 'for students') as ws_x, regexp_matches(ti, '(?:^|[^\p{L}\p{N}_])(?:werkstudent(?:[:*/._-]?in|en|entätigkeit)?|studentenjobs?|student job|working[ -]?student|student assistant|student employee|student worker|student(?:ische|ischer|isches)?[ -]+(?:hilfskraft|aushilfe|mitarbeiter(?:[:*/._-]?in)?))(?:$|[^\p{L}\p{N}_])') as ws_t, regexp_matches(de, '(?:^|[^\p{L}\p{N}_])(?:werkstudent(?:[:*/._-]?in|en|entätigkeit)?|studentenjobs?|student job|working[ -]?student|student assistant|student employee|student worker|student(?:ische|ischer|isches)?[ -]+(?:hilfskraft|aushilfe|mitarbeiter(?:[:*/._-]?in)?))(?:$|[^\p{L}\p{N}_])') as ws_d, regexp_matches(st, '(?:^|[^\p{L}\p{N}_])(?:praktikum|praktikant(?:[:*/._-]?in)?|pflichtpraktikum|freiwillig(?:es|en)?[ -]+praktikum|internship|intern|trainee intern|praxissemester)(?:$|[^\p{L}\p{N}_])') as in_s, platform = 'linkedin' and em in ('internship') as in_l, regexp_matches(ti, '(?:^|[^\p{L}\p{N}_])(?:praktikum|praktikant(?:[:*/._-]?in)?|pflichtpraktikum|freiwillig(?:es|en)?[ -]+praktikum|internship|intern|trainee intern|praxissemester)(?:$|[^\p{L}\p{N}_])') as in_t, regexp_matches(de, '(?:^|[^\p{L}\p{N}_])(?:praktikum|praktikant(?:[:*/._-]?in)?|pflichtpraktikum|freiwillig(?:es|en)?[ -]+praktikum|internship|intern|trainee intern|praxissemester)(?:$|[^\p{L}\p{N}_])') as in_d, coalesce(part_time_flag, false) as pt_f, regexp_matches(st, '(?:^|[^\p{L}\p{N}_])(?:teilzeit(?:stelle|job)?|part[ -]?time)(?:$|[^\p{L}\p{N}_])') as pt_s, platform = 'linkedin' and em in ('part-time', 'part time') as pt_l, platform = 'xing' and em in ('part-time', 'part time') as pt_x, regexp_matches(ti, '(?:^|[^\p{L}\p{N}_])(?:teilzeit(?:stelle|job)?|part[ -]?time)(?:$|[^\p{L}\p{N}_])') as pt_t, regexp_matches(de, '(?:^|[^\p{L}\p{N}_])(?:teilzeit(?:stelle|job)?|part[ -]?time)(?:$|[^\p{L}\p{N}_])') as pt_d, regexp_matches(st, '(?:^|[^\p{L}\p{N}_])(?:full[ -]?time|vollzeit|permanent contract|feste anstellung|contract|self-employed|temporary contract|befristeter vertrag)(?:$|[^\p{L}\p{N}_])') as contra from r1),
r3 as (select *, (ws_s or ws_x or ws_t) as ws_h, (in_s or in_l or in_t) as in_h, (pt_f or pt_s or pt_l or pt_x or pt_t) as pt_h from r2),
r4 as (select *, ws_d and not (ws_h or in_h or pt_h) as ws_e, in_d and not (ws_h or in_h or pt_h) as in_e from r3),
cls as (select *, ws_h or ws_e as is_working_student, in_h or in_e as is_internship, pt_h or pt_d as is_part_time, ws_h or ws_e or in_h or in_e or pt_h or pt_d as is_target_role,
  case when not (ws_h or ws_e or in_h or in_e or pt_h or pt_d) then null when ws_h or in_h or pt_h then 3 when ((ws_e or in_e) and not contra) or pt_d then 2 else 1 end as rnk from r4),
c0 as (select platform, job_id, nullif(trim(job_location), '') as loc, homeoffice_possible as ho, work_model as wm from uno),
c1 as (select *, (loc is not null and regexp_matches(lower(loc), '(remote|bundesweit|deutschlandweit|home\s*-?office|homeoffice|wfh|mobil|hybrid)')) or coalesce(ho, false) or (wm in ('Remote', 'Hybrid')) as remote_like, nullif(trim(regexp_replace(regexp_replace(lower(coalesce(loc, '')), '\([^\)]*\)', ' ', 'g'), '\s+', ' ', 'g')), '') as canon from c0),
c2 as (select platform, job_id, i, parts[i] as raw from (select platform, job_id, regexp_split_to_array(coalesce(canon, ''), '\s*(?:,|/|\|)\s*') as parts from c1) q, unnest(generate_series(1, len(parts))) as t(i)),
c3 as (select platform, job_id, i, nullif(trim(regexp_replace(regexp_replace(regexp_replace(raw, '(remote|bundesweit|deutschlandweit|home\s*-?office|homeoffice|wfh|mobil|hybrid)', ' ', 'g'), '\s+', ' ', 'g'), '^[,;\-\s\(\)\[\]]+|[,;\-\s\(\)\[\]]+$', '', 'g')), '') as tok from c2),
c4 as (select platform, job_id, tok, min(i) as ord, tok in ('bavaria', 'bayern', 'baden-württemberg', 'baden-wurttemberg', 'north rhine-westphalia', 'nordrhein-westfalen', 'lower saxony', 'niedersachsen', 'hesse', 'hessen', 'saxony', 'sachsen', 'saxony-anhalt', 'sachsen-anhalt', 'thuringia', 'thüringen', 'thueringen', 'rhineland-palatinate', 'rheinland-pfalz', 'schleswig-holstein', 'saarland', 'brandenburg', 'mecklenburg-vorpommern', 'mecklenburg western pomerania', 'greater munich metropolitan area', 'kanton zürich', 'canton zurich') as adm from c3 where tok is not null and length(tok) >= 2 and tok not in ('remote', 'bundesweit', 'deutschlandweit', 'home office', 'home-office', 'homeoffice', 'hybrid', 'mobil', 'wfh', 'de', 'at', 'ch', 'dach', 'germany', 'deutschland', 'austria', 'oesterreich', 'österreich', 'switzerland', 'schweiz') group by platform, job_id, tok),
c5 as (select *, row_number() over (partition by platform, job_id order by ord, tok) as idx, count(*) over (partition by platform, job_id) as total, bool_and(adm) over (partition by platform, job_id) as only_adm from c4),
cand as (select platform, job_id, 'city' as kind, idx, tok, total, least(total, 10) as used, remote_like from c5 join c1 using (platform, job_id) where idx <= 10 and (not adm or only_adm)
  union all select platform, job_id, 'remote', null, null, coalesce(total, 0), least(coalesce(total, 0), 10), remote_like from c1 left join (select distinct platform, job_id, total from c5) using (platform, job_id) where remote_like),
pt as (select cand.*, case when kind = 'remote' then 'Remote / Bundesweit' else array_to_string(list_transform(regexp_extract_all(tok, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda w: upper(w[1]) || w[2:]), '') end as label, g.lat, g.lon, g.city as gcity, g.status as gstatus,
  case when kind = 'remote' then case when used > 0 then 1.0::double / (used + 1) else 1.0::double end when remote_like then 1.0::double / (used + 1) else 1.0::double / used end as weight from cand left join star_geo g on kind = 'city' and g.location_text_norm = tok and g.country_scope = 'de'),
bub0 as (select pt.*, uno.event_ts, uno.company_name, uno.posted_at_utc, uno.first_seen_at, coalesce(nullif(gcity, ''), label) as bl from pt join uno using (platform, job_id) where kind = 'city' and lat is not null and lon is not null),
bub as (select lat, lon, bl, count(distinct platform || job_id) as jobs_unique, cast(sum(cast(round(weight * 27720) as bigint)) as double) / 27720 as jobs_weighted, count(distinct case when event_ts >= timestamp '2001-08-01 00:00:00' - interval 1 day then platform || job_id end) as new_24h_unique,
  count(distinct case when event_ts >= timestamp '2001-08-01 00:00:00' - interval 7 day then platform || job_id end) as new_7d_unique from bub0 group by all)
