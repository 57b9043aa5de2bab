"""Hand-made CSV feeds covering the awkward cases of the warehouse (see FIXTURES.md §A)."""
import os

LISTINGS_HEADER = ("LISTING_ID,URL,SCRAPED_DATE,HOST_ID,HOST_NAME,HOST_SINCE,HOST_IS_SUPERHOST,"
                   "HOST_NEIGHBOURHOOD,LISTING_NEIGHBOURHOOD,PROPERTY_TYPE,ROOM_TYPE,ACCOMMODATES,PRICE,"
                   "HAS_AVAILABILITY,AVAILABILITY_30,NUMBER_OF_REVIEWS,REVIEW_SCORES_RATING,"
                   "REVIEW_SCORES_ACCURACY,REVIEW_SCORES_CLEANLINESS,REVIEW_SCORES_CHECKIN,"
                   "REVIEW_SCORES_COMMUNICATION,REVIEW_SCORES_VALUE")

LISTINGS = [
    # r1: quoted comma in a name, host neighbourhood matching a suburb only ignoring case
    '1,u1,2020-01-15,10,"Smith, Jo",2015-01-01,t,bronte,Waverley,House,Entire,4,100,t,10,5,90,9,9,9,9,9',
    # r2: price 1999 is kept
    '1,u1,2020-02-15,10,"Smith, Jo",2015-01-01,t,bronte,Waverley,House,Entire,4,1999,t,0,5,95,9,9,9,9,9',
    # r3: price 2000 is dropped; '93.0' in an integer column
    '2,u2,2020-01-20,11,Ann,2016-05-05,f,Bondi,Waverley,Apartment,Private,93.0,2000,t,5,3,80,8,8,8,8,8',
    # r4: NULL price (\\N) is dropped
    '3,u3,2020-01-20,11,Ann,2016-05-05,f,Bondi,Waverley,Apartment,Private,2,\\N,f,30,1,NULL,8,8,8,8,8',
    # r5: NULL in both composite keys (NUL host_since, empty number_of_reviews); unknown suburb
    '4,u4,2020-01-25,12,Bob,NUL,f,Atlantis,Sydney,House,Shared,1,150,f,20,,70,7,7,7,7,7',
    # r6: listing neighbourhood differing from its LGA only by case: no LGA
    '4,u4,2020-03-25,12,Bob,2014-01-01,f,Surry Hills,sydney,House,Shared,1,150,t,20,2,70,7,7,7,7,7',
    # r7: Sydney has no row in 2020-02 (gap) and no active row at all
    '5,u5,2020-03-05,13,Cy,2019-01-01,t,Surry Hills,Sydney,House,Shared,1,120,f,25,0,60,6,6,6,6,6',
    # r8: suburb listed under two LGAs: the fact row is doubled
    '6,u6,2020-01-10,14,Dee,2017-07-07,t,BONDI,Waverley,Apartment,Entire,3,200,f,15,7,88,9,9,9,9,9',
]
LISTINGS_MORE = [
    # r10: in a sub-folder
    '7,u7,2020-02-01,15,Eve,2018-01-01,t,Bronte,Waverley,House,Entire,4,300,t,0,1,100,9,9,9,9,9',
]

FEEDS = {
    "census_1": "LGA_CODE_2016,Tot_P_M,Tot_P_F,Tot_P_P\nLGA10001,100,110,210\nLGA10002,200,220,420\nLGA10003,5,5,10\n",
    "census_2": ("LGA_CODE_2016,a,b,c,d,e,f,g,h\n"
                 "LGA10001,40,2000,900,500,2100,1.1,1800,2.5\nLGA10002,35,2500,1000,600,2300,1.2,2000,2.1\n"),
    "lga_code": "LGA_CODE,LGA_NAME\n10001,Waverley\n10002,Sydney\n",
    "lga_suburb": "LGA_NAME,SUBURB_NAME\nWAVERLEY,Bondi\nwaverley,Bronte\nSydney,Surry Hills\nSydney,Bondi\n",
}


def write_fixture(root: str) -> dict[str, str]:
    """Write the five feed folders (plus a non-CSV file and a sub-folder); return their paths."""
    paths = {}
    for name, text in FEEDS.items():
        d = os.path.join(root, name)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write(text)
        paths[name] = d
    d = os.path.join(root, "listings")
    os.makedirs(os.path.join(d, "more"), exist_ok=True)
    with open(os.path.join(d, "listings_2020.csv"), "w") as f:
        f.write("\n".join([LISTINGS_HEADER] + LISTINGS) + "\n")
    with open(os.path.join(d, "more", "listings_late.csv"), "w") as f:
        f.write("\n".join([LISTINGS_HEADER] + LISTINGS_MORE) + "\n")
    with open(os.path.join(d, "README.txt"), "w") as f:
        f.write("not,a,feed\n1,2,3\n")
    paths["listings"] = d
    return paths
