SELECT p_partkey AS row_id,
  cast(p_partkey - CASE WHEN p_partkey % 20 = 19 THEN 1 ELSE 0 END AS string) AS id,
  concat(p_name, ' ', lower(p_type), ' no', replace(p_brand, 'Brand#', ' ')) AS title,
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '2021-13-01'
       ELSE concat(cast(1950 + p_partkey % 70 AS string), '-06-15') END AS release_date,
  CASE WHEN p_partkey % 31 = 0 THEN '0' WHEN p_partkey % 37 = 0 THEN '900'
       ELSE cast(60 + 2 * p_size AS string) END AS runtime,
  CASE WHEN p_partkey % 5 = 0 THEN '0' WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN '-5'
       ELSE concat('$', cast(1000 * (1 + p_partkey * 977 % 90000) AS string), ' (estimated)') END AS budget,
  CASE WHEN p_partkey % 11 = 0 THEN '0' ELSE cast(1000 * (p_partkey * 7919 % 300007) AS string) END AS revenue,
  cast(p_partkey % 101 AS double) / 10 AS vote_average,
  p_partkey * 13 % 500 AS vote_count,
  cast(p_partkey * 7919 % 10007 AS double) / 100 AS popularity,
  CASE p_partkey % 6 WHEN 0 THEN concat('[', chr(39), 'Sci-Fi', chr(39), ', ', chr(39), 'Drama', chr(39), ']')
       WHEN 1 THEN '["rom-com", "Comedy"]' WHEN 2 THEN 'Film-Noir|Drama' WHEN 3 THEN '[]'
       WHEN 4 THEN 'biography; action adventure' ELSE 'Drama, Drama' END AS genre_names,
  concat(' ', upper(substr(p_name, 1, 2))) AS original_language
FROM part
