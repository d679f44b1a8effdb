"""Small hand-written inputs in the native nested shape."""


def shelves(*pairs):
    return [{"name": name, "count": count} for name, count in pairs]


def many(n):
    return [str(i) for i in range(n)]


def book(book_id, **fields):
    return {"book_id": book_id, "title": f"T{book_id}", "authors": [{"author_id": "1", "role": ""}],
            "description": "", "average_rating": "3.50", "num_pages": "250", "ratings_count": "50",
            "text_reviews_count": "5", "popular_shelves": [], "series": [], "similar_books": [], **fields}


RAW_BOOKS = [
    book("1", num_pages="99", average_rating="0", ratings_count="11", series=[], similar_books=many(1),
         description="toward award", popular_shelves=shelves(("to-read", "90"), ("b", "7"), ("a", "7"), ("c", "x"))),
    book("2", num_pages="100", average_rating="0.99", ratings_count="99", series=many(1), similar_books=many(5),
         description="Self-Help for the WORLD", popular_shelves=shelves(("to-read", "3"), ("owned", "2"))),
    book("3", num_pages="199", average_rating="1.0", ratings_count="100", series=many(2), similar_books=many(6),
         description=" ", popular_shelves=shelves(*[(f"s{i}", str(i)) for i in range(5)])),
    book("4", num_pages="200", average_rating="2.99", ratings_count="999", series=many(3), similar_books=many(10),
         description="!!!", popular_shelves=shelves(*[(f"s{i}", str(i)) for i in range(6)])),
    book("5", num_pages="699", average_rating="3.0", ratings_count="1000", series=many(4), similar_books=many(11),
         description="إسطاسية", popular_shelves=shelves(*[(f"s{i}", str(i)) for i in range(11)])),
    book("6", num_pages="700", average_rating="3.99", ratings_count="9999", series=None, similar_books=many(20),
         description=None, popular_shelves=None),
    book("7", num_pages=1, average_rating=4.0, ratings_count=10000, similar_books=many(21),
         popular_shelves=shelves(*[(f"s{i}", str(i)) for i in range(50)])),
    book("8", num_pages="", average_rating="5.0", ratings_count="999999", similar_books=many(50),
         popular_shelves=shelves(*[(f"s{i}", str(i)) for i in range(51)])),
    book("9", num_pages="0", average_rating="", ratings_count="1000000", similar_books=many(51)),
    book("10", num_pages=None, ratings_count="10", similar_books=None),
    book("11", num_pages="many", ratings_count=None, authors=None),
]


def review(book_id, user_id, text="a long enough text", rating="4", votes="0", date="Mon May 01"):
    return {"book_id": book_id, "user_id": user_id, "review_text": text, "rating": rating,
            "n_votes": votes, "date_added": date}


RAW_REVIEWS = [
    review("1", "u1", text="0123456789", rating="0"),
    review("1", "u2", text="0123456789a", rating="1"),
    review("1", "u3", text=None, rating=5),
    review("2", "u1", text="good, good bad", rating=None),
    review("2", "u2", text="good,bad", rating="5", votes=""),
    review("404", "u1", text="a review of an unknown book", rating="5"),
]
