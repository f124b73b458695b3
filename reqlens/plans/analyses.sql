-- The analyses of the transformed layer as statements over the view `requests`.
-- Means, shares and percentages are exact: integers in hundredths, rounded half up once.

CREATE OR REPLACE TEMPORARY FUNCTION half_up(num BIGINT, den BIGINT) RETURNS BIGINT
  RETURN CASE WHEN den > 0 THEN sign(num) * ((2 * abs(num) + den) DIV (2 * den)) END;

CREATE OR REPLACE TEMPORARY FUNCTION hundredths(n BIGINT) RETURNS DOUBLE
  RETURN CAST(n AS DOUBLE) / 100;

CREATE OR REPLACE TEMPORARY FUNCTION percent_of(part BIGINT, whole BIGINT) RETURNS DOUBLE
  RETURN hundredths(half_up(part * 10000, whole));

CREATE OR REPLACE TEMPORARY FUNCTION as_cents(hours DOUBLE) RETURNS BIGINT
  RETURN CAST(round(hours * 100) AS BIGINT);

-- title: total_rows
SELECT count(*) AS total_rows FROM requests;

-- title: sample_features
SELECT unique_key, request_date, request_day_of_week, request_hour, resolution_time_hours
FROM requests
ORDER BY unique_key NULLS LAST, request_date NULLS LAST, request_day_of_week NULLS LAST,
         request_hour NULLS LAST, resolution_time_hours NULLS LAST
LIMIT 5;

-- title: top_complaints_by_borough
WITH counted AS (
  SELECT borough, complaint_type, count(*) AS num_complaints FROM requests
  WHERE borough <> 'Unspecified' GROUP BY borough, complaint_type
), placed AS (
  SELECT *, rank() OVER (PARTITION BY borough ORDER BY num_complaints DESC) AS complaint_rank,
         sum(num_complaints) OVER (PARTITION BY borough) AS whole FROM counted
)
SELECT borough, complaint_type, num_complaints, complaint_rank, percent_of(num_complaints, whole) AS complaint_share_percentage
FROM placed WHERE complaint_rank <= 3
ORDER BY borough, complaint_rank, complaint_type NULLS FIRST;

-- title: high_volume_complaints
WITH counted AS (
  SELECT complaint_type, count(*) AS total_request_count, count(resolution_time_hours) AS resolved_request_count,
         sum(as_cents(resolution_time_hours)) AS cents
  FROM requests GROUP BY complaint_type
)
SELECT complaint_type, total_request_count, resolved_request_count,
       hundredths(half_up(cents, resolved_request_count)) AS average_resolution_time_hours
FROM counted
WHERE total_request_count > (SELECT avg(total_request_count) FROM counted)
ORDER BY average_resolution_time_hours DESC NULLS LAST, complaint_type NULLS FIRST;

-- title: agency_workload_speed
WITH desk AS (
  SELECT agency, count(*) AS total_requests, count(resolution_time_hours) AS resolved_requests,
         hundredths(half_up(sum(as_cents(resolution_time_hours)), count(resolution_time_hours))) AS avg_resolution_hours
  FROM requests GROUP BY agency
)
SELECT *, rank() OVER (ORDER BY total_requests DESC) AS workload_rank,
       CASE WHEN avg_resolution_hours IS NOT NULL THEN rank() OVER (ORDER BY avg_resolution_hours NULLS LAST) END AS speed_rank
FROM desk ORDER BY workload_rank, agency NULLS FIRST;

-- title: borough_coverage
SELECT borough, count(*) AS total_request_count, count(resolution_time_hours) AS resolved_request_count,
       hundredths(half_up(sum(as_cents(resolution_time_hours)), count(resolution_time_hours))) AS avg_resolution_time_hours,
       percent_of(count(resolution_time_hours), count(*)) AS resolution_coverage_percentage
FROM requests WHERE borough <> 'Unspecified' GROUP BY borough
ORDER BY avg_resolution_time_hours DESC NULLS LAST, borough;

-- title: peak_hours
WITH clock AS (SELECT request_hour AS h, count(*) AS n FROM requests GROUP BY request_hour)
SELECT lpad(CAST(h AS STRING), 2, '0') || ':00' AS request_hour, n AS hourly_request_count,
       dense_rank() OVER (ORDER BY n DESC) AS request_hour_rank,
       percent_of(n, sum(n) OVER ()) AS hour_share_percentage
FROM clock ORDER BY h NULLS FIRST;

-- title: weekday_pattern
WITH days AS (
  SELECT request_date, request_day_of_week, count(*) AS n,
         half_up(sum(as_cents(resolution_time_hours)), count(resolution_time_hours)) AS mean
  FROM requests WHERE request_date IS NOT NULL GROUP BY request_date, request_day_of_week
), inner_days AS (
  SELECT * FROM days
  WHERE request_date > (SELECT min(request_date) FROM days) AND request_date < (SELECT max(request_date) FROM days)
)
SELECT request_day_of_week,
       CASE WHEN request_day_of_week IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       hundredths(half_up(sum(n) * 100, count(*))) AS average_requests_per_day,
       hundredths(half_up(sum(mean), count(mean))) AS average_resolution_hours,
       rank() OVER (ORDER BY sum(n) / count(*) DESC) AS day_rank
FROM inner_days GROUP BY request_day_of_week
ORDER BY array_position(array('Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'), request_day_of_week);

-- title: daily_spikes
WITH days AS (SELECT request_date, count(*) AS n FROM requests GROUP BY request_date),
usual AS (SELECT half_up(sum(n) * 100, count(*)) AS mean FROM days)
SELECT request_date, n AS daily_request_count, hundredths(mean) AS avg_daily_requests,
       hundredths(half_up((n * 100 - mean) * 10000, nullif(mean, 0))) AS percentage_difference,
       CASE WHEN n * 100 > mean THEN 'Above Average' WHEN n * 100 < mean THEN 'Below Average' ELSE 'Average' END AS comparison_status
FROM days CROSS JOIN usual -- one row
ORDER BY request_date NULLS FIRST;

-- title: peak_hour_by_complaint
WITH counted AS (SELECT complaint_type, request_hour, count(*) AS n FROM requests GROUP BY complaint_type, request_hour),
commonest AS (
  SELECT complaint_type FROM (
    SELECT complaint_type, rank() OVER (ORDER BY sum(n) DESC) AS place FROM counted GROUP BY complaint_type) WHERE place <= 10
), placed AS (
  SELECT *, dense_rank() OVER (PARTITION BY complaint_type ORDER BY n DESC) AS hour_rank
  FROM counted LEFT SEMI JOIN commonest USING (complaint_type)
)
SELECT complaint_type, lpad(CAST(request_hour AS STRING), 2, '0') || ':00' AS request_hour, n AS hourly_request_count, hour_rank
FROM placed WHERE hour_rank <= 3
ORDER BY complaint_type, hour_rank, placed.request_hour NULLS FIRST;

-- title: complaint_resolution_by_borough
WITH counted AS (
  SELECT complaint_type, borough, count(*) AS n, count(resolution_time_hours) AS done, sum(as_cents(resolution_time_hours)) AS cents
  FROM requests GROUP BY complaint_type, borough
), commonest AS (
  SELECT complaint_type FROM (
    SELECT complaint_type, rank() OVER (ORDER BY sum(n) DESC) AS place FROM counted GROUP BY complaint_type) WHERE place <= 10
)
SELECT complaint_type, borough, done AS resolved_requests, hundredths(half_up(cents, done)) AS avg_resolution_hours,
       dense_rank() OVER (PARTITION BY complaint_type ORDER BY cents / done DESC) AS resolution_rank
FROM counted LEFT SEMI JOIN commonest USING (complaint_type)
WHERE done >= 100 AND borough <> 'Unspecified'
ORDER BY complaint_type, resolution_rank, borough;
