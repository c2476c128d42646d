"""Hand-written edge feeds (FIXTURES.md section 4) and their expected results."""

FEED1 = """01-02-2024 09:00:00,North,Ann Ode,"Large Latte - Hazelnut - 2.75, Tea - 1.30",4.05,CARD,4444000011112222
01-02-2024 09:00:00,North,Ann Ode,"Tea - 1.30, Tea - 1.30",2.60,CASH,
01-02-2024 09:05:00,South,Ann Ode,"Large Latte - Hazelnut - 2.95",2.95,CASH,
01-02-2024 09:00:00,North,Ann Ode,"Tea - 1.30, Tea - 1.30",2.60,CASH,
01-02-2024 09:06:00,South,,"Mocha - Mint - Extra - 3.10",3.10,CASH,
31-02-2024 09:07:00,North,Bo Lin,"Tea - 1.30",1.30,CASH,
01-02-2024 09:08:00,North,Bo Lin,"Tea - 1.30",xx,CASH,
01-02-2024 09:09:00,North,Bo Lin,"Tea - 1.30, Water",1.30,CASH,
short,row
"""

FEED2 = """02-02-2024 10:00:00,East,Bo Lin,"Tea - 9.99, Cocoa - Cherry - 2.00",11.99,CARD,4444000011113333
"""

ANN = "cb180743605505062d79e741de097394"
EMPTY = "d41d8cd98f00b204e9800998ecf8427e"
BO = "67c5c58f94d4604d5a7eab6f5aeefdd4"


def write(dir_, name, text):
    import os

    os.makedirs(dir_, exist_ok=True)
    with open(os.path.join(dir_, name), "w") as f:
        f.write(text)
    return os.path.join(dir_, name)
