"""A small shop as raw CSV files, with the defects the load has to repair."""

from pathlib import Path

FILES = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-01-05 10:00:00,,,2017-01-09 09:00:00,2017-01-20 00:00:00
o2,c2,delivered,2017-03-05 10:00:00,,,2017-03-30 11:00:00,2017-03-20 00:00:00
o3,c3,shipped,2017-03-06 10:00:00,,,,2017-03-20 00:00:00
o4,c4,canceled,2017-03-07 10:00:00,,,,2017-03-20 00:00:00
o5,c5,approved,2017-04-07 10:00:00,,,,2017-04-20 00:00:00
o6,c6,delivered,2017-04-08 10:00:00,,,2017-04-10 10:00:00,2017-04-20 00:00:00
o7,c7,delivered,2017-04-09 10:00:00,,,2017-04-11 10:00:00,2017-04-20 00:00:00
o8,ghost,delivered,2017-04-09 10:00:00,,,2017-04-11 10:00:00,2017-04-20 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-01-08 00:00:00,50.00,5.25
o1,2,p2,s1,2017-01-08 00:00:00,150.01,5.25
o2,1,p1,s2,2017-03-08 00:00:00,500.00,10.00
o3,1,p3,s1,2017-03-08 00:00:00,20.10,1.00
o4,1,p1,s1,2017-03-08 00:00:00,999.00,1.00
o6,1,p4,s2,2017-03-08 00:00:00,30.00,0.00
o7,1,missing,s3,2017-03-08 00:00:00,40.00,0.00
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,voucher,1,60.25
o1,2,credit_card,8,150.26
o2,1,credit_card,13,510.00
o3,1,boleto,1,21.10
o4,1,credit_card,3,1000.00
o6,1,boleto,1,30.00
o7,1,debit_card,1,20.00
o7,2,boleto,1,20.00
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01310,sao paulo,SP
c2,u1,20000,rio,RJ
c3,u2,01311,sao paulo,SP
c4,u2,01311,sao paulo,SP
c5,u3,30000,belo,MG
c6,u4,30000,belo,MG
c7,u5,30000,belo,MG
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,relogios_presentes,40,287,1,225,16,10,14
p2,sem_traducao,44,276,1,1000,30,18,20
p3,,,,,,,,
p4,beleza_saude,46,250,1,154,18,9,15
""",
    "category_translation": """product_category_name,product_category_name_english
relogios_presentes,watches_gifts
beleza_saude,health_beauty
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,01001,sao paulo,SP
s2,20001,rio,RJ
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01037,-23.54,-46.63,sao paulo,SP
""",
    "order_reviews": '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"good,
two ""lines""",2017-01-18 00:00:00,2017-01-18 21:46:59
r2,o1,4,,,2017-01-18 00:00:00,2017-01-18 21:46:59
r3,o2,1,late,,2017-04-18 00:00:00,2017-04-18 21:46:59
r4,o4,3,,,2017-03-18 00:00:00,2017-03-18 21:46:59
''',
    "mql": """mql_id,first_contact_date,landing_page_id,origin
m1,2018-02-01,l1,social
m2,2018-02-10,l1,social
m3,2018-03-01,l2,
m4,2018-03-02,l2,
m5,2018-03-03,l2,paid_search
""",
    "closed_deals": """mql_id,seller_id,sdr_id,sr_id,won_date,business_segment,lead_type,lead_behaviour_profile,has_company,has_gtin,average_stock,business_type,declared_product_catalog_size,declared_monthly_revenue
m1,s1,d1,r1,2018-02-11,pet,online_medium,cat,True,,,reseller,,0
m3,s2,d1,r1,2018-02-27,,industry,eagle,,False,,manufacturer,,1000.5
m4,s3,d1,r1,2018-03-22,pet,,,,,,reseller,,
m9,s4,d1,r1,2018-03-22,toys,online_big,cat,,,,reseller,,0
""",
}


def write(folder: Path) -> str:
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)
