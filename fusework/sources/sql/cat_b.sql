SELECT p_partkey AS row_id, p_partkey AS src_key,
  concat('/title/tt', lpad(cast(p_partkey AS string), 7, '0'), '/') AS path,
  CASE WHEN p_partkey % 52 = 0 THEN NULL WHEN p_partkey % 76 = 0 THEN '1917' ELSE
    CASE p_partkey % 20
      WHEN 0 THEN concat('The ', p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' '))
      WHEN 4 THEN concat(p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' '), ' (', cast(1950 + p_partkey % 70 AS string), ')')
      WHEN 8 THEN replace(concat(p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' ')), 'e', 'é')
      WHEN 12 THEN replace(concat(p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' ')), 'i', 'y')
      ELSE upper(concat(p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' '))) END END AS movie_title,
  CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE -1 END
    * (1950 + p_partkey % 70 + CASE WHEN p_partkey % 20 = 16 THEN 1 ELSE 0 END) AS year,
  CASE p_partkey % 9 WHEN 0 THEN '2 hours 27 minutes' WHEN 1 THEN '142' WHEN 2 THEN 'not-released'
       WHEN 3 THEN '$5,000,000 (estimated)' WHEN 4 THEN '7.8' WHEN 5 THEN '1:45' WHEN 6 THEN NULL
       WHEN 7 THEN concat(cast(60 + 2 * p_size AS string), ' min') ELSE '1.5 hours' END AS run_time,
  CASE WHEN p_partkey % 29 = 0 THEN 'n/a' ELSE cast(cast(p_partkey % 97 AS double) / 10 AS string) END AS rating,
  CASE p_partkey % 3 WHEN 0 THEN '187K' WHEN 1 THEN '1.2M' ELSE '1,500' END AS user_rating,
  CASE p_partkey % 3 WHEN 0 THEN 'Drama, Sci-Fi' WHEN 1 THEN '["Comedy"]' ELSE NULL END AS generes,
  CASE WHEN p_partkey % 13 = 0 THEN 'See company contact information'
       ELSE concat('Director ', cast(p_partkey % 37 AS string)) END AS director,
  CASE WHEN p_partkey % 8 = 0 THEN '' ELSE concat('a ', p_name, ' story about ', lower(p_type)) END AS overview,
  concat(p_name, ',', lower(p_type)) AS plot_kyeword, '' AS top_5_casts, '' AS writer
FROM part WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey + 1000000000 AS row_id, p_partkey AS src_key,
  concat('/title/dup', cast(p_partkey AS string), '/') AS path,
  upper(concat(p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' '))) AS movie_title,
  -(1950 + p_partkey % 70) AS year, NULL AS run_time, NULL AS rating, '1,500' AS user_rating,
  NULL AS generes, 'Director dup' AS director, '' AS overview, '' AS plot_kyeword, '' AS top_5_casts, '' AS writer
FROM part WHERE p_partkey % 40 = 4
