"""The 99 published internet bundle rules that the fixtures use."""

# Rule, discount, method, rule type, internet group, contract months, mobile total from and to, line
# fee from and to, target, allocation, amount.
DISCOUNT_ROWS = """
('R001','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',12,0,21999,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R002','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',12,0,21999,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',550.0),
('R003','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',12,22000,64899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R004','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',12,22000,64899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R005','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',12,64900,108899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',1375.0),
('R006','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',12,64900,108899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R007','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',12,108900,141899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',4152.5),
('R008','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',12,108900,141899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R009','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',12,141900,174899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',5527.5),
('R010','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',12,141900,174899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R011','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',12,174900,null,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',6902.5),
('R012','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',12,174900,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R013','D005','TOTAL','INTERNET_ADDITIONAL','BASIC_ESSENCE_PREMIUM',12,null,null,null,null,'INTERNET_ADDITIONAL',null,1375.0),
('R014','D005','FIXED','INTERNET_ADDITIONAL','BASIC_ESSENCE_PREMIUM',12,null,null,null,null,'INTERNET_ADDITIONAL',null,1375.0),
('R015','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',12,0,21999,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R016','D005','TOTAL','INTERNET_BASE','SLIM',12,0,21999,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',412.5),
('R017','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',12,22000,64899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R018','D005','TOTAL','INTERNET_BASE','SLIM',12,22000,64899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',825.0),
('R019','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',12,64900,108899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',825.0),
('R020','D005','TOTAL','INTERNET_BASE','SLIM',12,64900,108899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R021','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',12,108900,141899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',3575.0),
('R022','D005','TOTAL','INTERNET_BASE','SLIM',12,108900,141899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R023','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',12,141900,174899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',4675.0),
('R024','D005','TOTAL','INTERNET_BASE','SLIM',12,141900,174899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R025','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',12,174900,null,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',5775.0),
('R026','D005','TOTAL','INTERNET_BASE','SLIM',12,174900,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R027','D005','TOTAL','INTERNET_ADDITIONAL','SLIM',12,null,null,null,null,'INTERNET_ADDITIONAL',null,0.0),
('R028','D005','FIXED','INTERNET_ADDITIONAL','SLIM',12,null,null,null,null,'INTERNET_ADDITIONAL',null,0.0),
('R029','D002','FIXED','MOBILE_LINE','ANY',12,null,null,0,36999,'MOBILE_LINE',null,0.0),
('R030','D002','FIXED','MOBILE_LINE','ANY',12,null,null,37000,60999,'MOBILE_LINE',null,750.0),
('R031','D002','FIXED','MOBILE_LINE','ANY',12,null,null,61000,76999,'MOBILE_LINE',null,1250.0),
('R032','D002','FIXED','MOBILE_LINE','ANY',12,null,null,77000,null,'MOBILE_LINE',null,1750.0),
('R033','D005','FIXED','INTERNET_BASE','ANY',12,null,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1375.0),
('R034','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',24,0,21999,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R035','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',24,0,21999,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1100.0),
('R036','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',24,22000,64899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R037','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',24,22000,64899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R038','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',24,64900,108899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',2750.0),
('R039','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',24,64900,108899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R040','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',24,108900,141899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',8305.0),
('R041','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',24,108900,141899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R042','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',24,141900,174899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',11055.0),
('R043','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',24,141900,174899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R044','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',24,174900,null,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',13805.0),
('R045','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',24,174900,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R046','D005','TOTAL','INTERNET_ADDITIONAL','BASIC_ESSENCE_PREMIUM',24,null,null,null,null,'INTERNET_ADDITIONAL',null,2750.0),
('R047','D005','FIXED','INTERNET_ADDITIONAL','BASIC_ESSENCE_PREMIUM',24,null,null,null,null,'INTERNET_ADDITIONAL',null,2750.0),
('R048','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',24,0,21999,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R049','D005','TOTAL','INTERNET_BASE','SLIM',24,0,21999,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',825.0),
('R050','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',24,22000,64899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R051','D005','TOTAL','INTERNET_BASE','SLIM',24,22000,64899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1650.0),
('R052','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',24,64900,108899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',1650.0),
('R053','D005','TOTAL','INTERNET_BASE','SLIM',24,64900,108899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R054','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',24,108900,141899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',7150.0),
('R055','D005','TOTAL','INTERNET_BASE','SLIM',24,108900,141899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R056','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',24,141900,174899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',9350.0),
('R057','D005','TOTAL','INTERNET_BASE','SLIM',24,141900,174899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R058','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',24,174900,null,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',11550.0),
('R059','D005','TOTAL','INTERNET_BASE','SLIM',24,174900,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R060','D005','TOTAL','INTERNET_ADDITIONAL','SLIM',24,null,null,null,null,'INTERNET_ADDITIONAL',null,0.0),
('R061','D005','FIXED','INTERNET_ADDITIONAL','SLIM',24,null,null,null,null,'INTERNET_ADDITIONAL',null,0.0),
('R062','D002','FIXED','MOBILE_LINE','ANY',24,null,null,0,36999,'MOBILE_LINE',null,0.0),
('R063','D002','FIXED','MOBILE_LINE','ANY',24,null,null,37000,60999,'MOBILE_LINE',null,1500.0),
('R064','D002','FIXED','MOBILE_LINE','ANY',24,null,null,61000,76999,'MOBILE_LINE',null,2500.0),
('R065','D002','FIXED','MOBILE_LINE','ANY',24,null,null,77000,null,'MOBILE_LINE',null,3500.0),
('R066','D005','FIXED','INTERNET_BASE','ANY',24,null,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2750.0),
('R067','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',36,0,21999,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R068','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',36,0,21999,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',2200.0),
('R069','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',36,22000,64899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R070','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',36,22000,64899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R071','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',36,64900,108899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',5500.0),
('R072','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',36,64900,108899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R073','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',36,108900,141899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',16610.0),
('R074','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',36,108900,141899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R075','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',36,141900,174899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',22110.0),
('R076','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',36,141900,174899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R077','D001','TOTAL','MOBILE_TOTAL_POOL','BASIC_ESSENCE_PREMIUM',36,174900,null,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',27610.0),
('R078','D005','TOTAL','INTERNET_BASE','BASIC_ESSENCE_PREMIUM',36,174900,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R079','D005','TOTAL','INTERNET_ADDITIONAL','BASIC_ESSENCE_PREMIUM',36,null,null,null,null,'INTERNET_ADDITIONAL',null,5500.0),
('R080','D005','FIXED','INTERNET_ADDITIONAL','BASIC_ESSENCE_PREMIUM',36,null,null,null,null,'INTERNET_ADDITIONAL',null,5500.0),
('R081','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',36,0,21999,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R082','D005','TOTAL','INTERNET_BASE','SLIM',36,0,21999,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',1650.0),
('R083','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',36,22000,64899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',0.0),
('R084','D005','TOTAL','INTERNET_BASE','SLIM',36,22000,64899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',3300.0),
('R085','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',36,64900,108899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',3300.0),
('R086','D005','TOTAL','INTERNET_BASE','SLIM',36,64900,108899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R087','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',36,108900,141899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',14300.0),
('R088','D005','TOTAL','INTERNET_BASE','SLIM',36,108900,141899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R089','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',36,141900,174899,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',18700.0),
('R090','D005','TOTAL','INTERNET_BASE','SLIM',36,141900,174899,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R091','D001','TOTAL','MOBILE_TOTAL_POOL','SLIM',36,174900,null,null,null,'MOBILE_POOL','EQUAL_OR_CONTRIBUTION',23100.0),
('R092','D005','TOTAL','INTERNET_BASE','SLIM',36,174900,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0),
('R093','D005','TOTAL','INTERNET_ADDITIONAL','SLIM',36,null,null,null,null,'INTERNET_ADDITIONAL',null,0.0),
('R094','D005','FIXED','INTERNET_ADDITIONAL','SLIM',36,null,null,null,null,'INTERNET_ADDITIONAL',null,0.0),
('R095','D002','FIXED','MOBILE_LINE','ANY',36,null,null,0,36999,'MOBILE_LINE',null,0.0),
('R096','D002','FIXED','MOBILE_LINE','ANY',36,null,null,37000,60999,'MOBILE_LINE',null,3000.0),
('R097','D002','FIXED','MOBILE_LINE','ANY',36,null,null,61000,76999,'MOBILE_LINE',null,5000.0),
('R098','D002','FIXED','MOBILE_LINE','ANY',36,null,null,77000,null,'MOBILE_LINE',null,7000.0),
('R099','D005','FIXED','INTERNET_BASE','ANY',36,null,null,null,null,'BASE_INTERNET','BASE_MOBILE_OR_INTERNET_SPLIT',5500.0)
"""
