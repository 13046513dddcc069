-- Return rate by order priority and line status
SELECT o.o_orderpriority, l.l_linestatus,
       ROUND(AVG(CASE WHEN l.l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 2) AS rate_pct,
       COUNT(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderpriority, l.l_linestatus
ORDER BY rate_pct DESC;

-- Mean quantity and price of returned and kept lines
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
       ROUND(AVG(l_quantity), 2) AS avg_quantity,
       ROUND(AVG(l_extendedprice), 2) AS avg_price
FROM lineitem
GROUP BY CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END;

-- Return rate by line number
SELECT l_linenumber, COUNT(*) AS total,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
       ROUND(AVG(CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 2) AS rate_pct
FROM lineitem
GROUP BY l_linenumber
ORDER BY l_linenumber ASC;

-- Finished orders by customer segment and priority (join)
SELECT c.c_mktsegment, o.o_orderpriority, COUNT(*) AS n, ROUND(AVG(c.c_acctbal), 2) AS avg_acctbal
FROM customer c INNER JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F'
GROUP BY c.c_mktsegment, o.o_orderpriority
ORDER BY c.c_mktsegment, n DESC
