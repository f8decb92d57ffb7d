SELECT to_date(ts) AS bucket, event_type, count(*) AS events, CAST(floor(sum(value)) AS BIGINT) AS value
FROM events
WHERE ts >= CAST(:starts AS TIMESTAMP_NTZ) AND ts < CAST(date_add(CAST(:ends AS DATE), 1) AS TIMESTAMP_NTZ)
GROUP BY to_date(ts), event_type
