-- Transaction features of one cohort as of :cutoff over :window_days days.
-- Relations are bound as DataFrames, values as named parameters.
WITH recent AS (
  SELECT msno, is_auto_renew, is_cancel, :cutoff - transaction_date AS age, membership_expire_date - :cutoff AS ahead
  FROM {transactions}
  WHERE transaction_date <= :cutoff AND transaction_date > DATE_SUB(:cutoff, :window_days)
), per_subscriber AS (
  SELECT msno,
         MAX(EXTRACT(DAY FROM ahead)) AS days_until_expiration,
         MIN(EXTRACT(DAY FROM age)) AS days_since_last_transaction,
         SUM(is_cancel) AS cancellation_count_90,
         SUM(is_auto_renew) / COUNT(1) AS auto_renew_rate_90,
         COUNT(1) AS transaction_count_90
  FROM recent GROUP BY msno
)
SELECT * FROM per_subscriber WHERE EXISTS (SELECT 1 FROM {labels} AS l WHERE l.msno = per_subscriber.msno)
